"""Token ids of texts, in Arrow batches on the executors.

The tokenizer's files are read once by each Python worker. The ids are those of
the `tokenizers` file. Texts of common characters go through the faster library
that reads the same vocabulary as ranks; both split and merge such texts alike.
Others, where the libraries' character classes may differ, and texts that hold the
string of a special token, go through `tokenizers` itself.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np

MODEL, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Printable ASCII, tab and line ends, Latin letters and signs.
COMMON = re.compile("[\t\n\r -~¡-¬®-ɏ–—‘-‟…]*")
#: What every special token's string begins with in this vocabulary.
SPECIAL = "<|"


@cache
def _slow(path: str, plain: bool):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = plain
    return found


@cache
def _fast(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(MODEL), public_tokenizers.path(RANKS)


def encode(text: str, model: str | None = None, ranks: str | None = None, plain: bool = False) -> np.ndarray:
    """The ids of a text, unsigned 32 bits. A null text has none. A special token's
    string in a text becomes its id, or, with `plain`, is text like any other."""
    if not text:
        return np.empty(0, "<u4")
    model, ranks = model or paths()[0], ranks or paths()[1]
    if COMMON.fullmatch(text) and (plain or SPECIAL not in text):
        return _fast(ranks).encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
    return np.array(_slow(model, plain).encode(text, add_special_tokens=False).ids, "<u4")
