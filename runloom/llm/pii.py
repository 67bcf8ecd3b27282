"""Personal data: candidate spans by generators, kept or dropped by boosted trees.

Generators with high recall propose spans, which may overlap. The base kinds'
own rules accept some for certain. The others get features of format (digits,
separators, checksum) and context (words before, characters around) and a score
of gradient-boosted trees; thresholds, one for each kind, calibrated on held-out
documents, select what is redacted besides: obfuscated addresses, numbers in other
spellings, and secrets (a fifth kind: keys and passwords).

There are no labels of such spans, so the trees learn from spans whose truth is
known because they are made: at places of a bounded sample of documents, between
their own words, personal data in spellings that the base forms miss are put in,
and look-alikes of the same spelling: lots and versions, digests, paths, slugs, names in
code, numbers that fail their checksum. What a span was made as is its label; neither
forms nor checks have a say in it. Most are led in by words that no cue names, some
by a cue, and some look-alikes by the wrong one, so a cue is evidence and no more.
The trees are compiled into column expressions, so that a document is searched and
judged in one projection, without a shuffle; a learned scorer can be kept as text.

Defined results: a null text has no spans; very long texts are searched whole;
repeated rows, equal and null ids are rows of their own; spans that start at the
same place are listed by kind; an added span never touches a base span; other
columns, whatever their names, are passed through by `redact`; an empty table gives
an empty result. Places are in code points.
"""

from __future__ import annotations

import json
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checked_broadcast, cut, let, quoted, text_of

KINDS = ("email", "ip", "card", "phone")
#: A kind that only the trees select.
SECRET = "secret"
SPAN = "struct<kind:string,start:int,end:int,s:string>"

#: The base forms. Runs are matched possessively, which changes no match, as what
#: follows a run can't be in it, and takes steps in proportion to the text.
#: \G lets a match start where the last one ended, inside a run.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a form to be in it.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

#: Wider forms: their matches are candidates only. The kind, then the form.
WIDER = (
    ("email", r"(?i)\b[a-z0-9][a-z0-9._%+-]{0,63}\s?(?:\(at\)|\[at\]|\{at\})\s?[a-z0-9-]{1,63}(?:(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\})\s?)[a-z0-9-]{1,63}){1,8}"),
    ("phone", r"(?<![\w+.-])(?:\(\d{3}\)\s?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])"),
    ("phone", r"(?<![\w+.-])00\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"),
    ("card", r"(?<![\w.-])\d{4}(?:[ .-]\d{4}){3}(?![\w-])"),
    ("ip", r"(?<![\w.])\d{1,3}(?:\s?(?:\[\.\]|\(\.\))\s?\d{1,3}){3}(?!\w)"),
    (SECRET, r"(?<![\w+/-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+(?!\w)"),
)

#: Words that tell what follows.
CUES = r"(?i)(?:phone|tel|call|fax|mobile|cell|mail|e-mail|contact|reach|write|card|visa|ip|host|server|address|from)\W{0,12}$"
COUNTER_CUES = r"(?i)(?:version|ver|v|release|isbn|issn|doi|order|invoice|serial|id|no|nr|ref|sku|token|hash|build)\W{0,6}$"

FEATURES = (
    "digits", "length", "separators", "luhn", "first_part", "parts_fit", "is_email", "is_ip", "is_card", "is_phone",
    "cue", "counter_cue", "secret_cue", "assigned", "in_code", "glued_before", "glued_after", "obfuscated", "same_digit",
    "hexadecimal", "both_cases", "slashes", "joints", "longest_word", "variety", "digit_share",
)
SECRET_CUES = r"(?i)(?:token|secret|key|passw(?:or)?d|pwd|bearer|auth|credentials?)[\"']?\W{0,4}$"

#: What is put before spans that are made to learn from. No cue names these.
LEADS = ("", "ring ", "my number is ", "drop a line to ", "ping ", "charged to ", "log in at ", "she is on ", "you get us under ", "or ask ")
COUNTER_LEADS = ("", "lot ", "batch ", "case ", "part ", "article ", "row ", "between ", "figure ", "stock ")
SECRET_LEADS = ('x = "', "export A=", "login with ", '"value": "', "use ", "sign in as me: ", "-p ", "set to '")
DIGEST_LEADS = ("", "commit ", "sha256: ", "checksum ", "blob ", 'href="', "see /img/", "object ", "at ", "called ", "x = ", "module: ")
#: Such that a cue does.
CUED = ("call me on ", "tel: ", "contact ", "write to ", "my card: ", "mail ", "the server ")
COUNTERED = ("order ", "version ", "invoice no. ", "ISBN ", "build ", "ref. ", "serial ")
SECRET_CUED = ("api_key: ", "password=", 'secret: "', "Authorization: Bearer ", "AUTH_TOKEN=", 'access key "')

#: Bounds of the sample that the trees are learned from.
SAMPLE_DOCS, SAMPLE_CANDIDATES = 4_000, 12_000
ROUNDS, DEPTH, PRECISION = 12, 4, 0.97


def matches(text: Column, form: str, kind: str) -> Column:
    """All matches of a form, leftmost and without overlap, with their places.
    Splitting at the form gives the gaps, extracting gives the matches: lengths,
    summed up alternately, are the places."""

    def place(found: Column) -> Column:
        gaps = F.split(text, form, -1)
        step = lambda acc, i: F.struct(
            (acc["at"] + F.length(F.get(acc["g"], i)) + F.length(F.get(found, i))).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        F.lit(kind).alias("kind"), (acc["at"] + F.length(F.get(acc["g"], i))).alias("start"),
                        (acc["at"] + F.length(F.get(acc["g"], i)) + F.length(F.get(found, i))).alias("end"), F.get(found, i).alias("s"),
                    )
                ),
            ).alias("out"),
            acc["g"].alias("g"),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"), gaps.alias("g"))
        walked = F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), start, step, lambda acc: acc["out"])
        return F.when(F.size(found) > 0, walked).otherwise(F.array().cast(f"array<{SPAN}>"))

    return let(F.regexp_extract_all(text, F.lit(form), F.lit(0)), place)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def base_holds(x: Column) -> Column:
    """Whether a match of a base form passes its kind's check."""
    s, n = x["s"], F.length(digits(x["s"]))
    parts = F.transform(F.split(s, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    ip = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    card = F.when(n.between(16, 19), luhn(digits(s))).otherwise(F.lit(False))
    return (
        F.when(x["kind"] == "email", F.lit(True))
        .when(x["kind"] == "ip", ip)
        .when(x["kind"] == "card", card)
        .otherwise(n.between(8, 15))
    )


def candidates(text: Column) -> Column:
    """Array of spans with `base` (passes the base rule) and `wider`."""

    def mark(spans: Column, base: Column | None) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(
                x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["s"].alias("s"),
                (base_holds(x) if base is None else base).alias("base"),
            ),
        )

    none = F.array().cast("array<struct<kind:string,start:int,end:int,s:string,base:boolean>>")
    has_digit = text.rlike("[0-9]")
    found = []
    for kind in KINDS:
        hint = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else has_digit
        hint = text.rlike(r"[0-9]\.[0-9]") if kind == "ip" else text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}") if kind == "card" else hint
        found.append(F.when(hint, mark(matches(text, FORMS[kind], kind), None)).otherwise(none))
    for kind, form in WIDER:
        hints = {"email": r"[({\[](?i:at)[)}\]]", "ip": r"\d\s?[\[(]\.[\])]", SECRET: r"[0-9][A-Za-z+/_-]|[A-Za-z+/_-][0-9]"}
        hint = text.rlike(hints[kind]) if kind in hints else has_digit
        found.append(F.when(hint, mark(matches(text, form, kind), F.lit(False))).otherwise(none))
    # Runs of a few digits are too short for any number that is looked for.
    long_enough = lambda x: x["base"] | ~x["kind"].isin("card", "phone") | (F.length(digits(x["s"])) >= F.when(x["kind"] == "card", 12).otherwise(7))
    return F.filter(F.flatten(F.array(*found)), long_enough)


def features(text: Column, x: Column) -> dict[str, Column]:
    s, d = x["s"], digits(x["s"])
    before = F.substring(text, F.greatest(x["start"] - 23, F.lit(1)), F.least(x["start"], F.lit(24)))
    after = F.substring(text, x["end"] + 1, F.lit(1))
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    part = F.regexp_extract(s, "^[^0-9]*([0-9]{1,9})", 1)
    return {
        "digits": F.length(d).cast("double"),
        "length": F.length(s).cast("double"),
        "separators": F.length(F.regexp_replace(s, r"[^ .()-]", "")).cast("double"),
        "luhn": flag(F.when(F.length(d) > 1, luhn(d))),
        "first_part": F.coalesce(part.try_cast("double"), F.lit(-1.0)),
        "parts_fit": flag(F.forall(F.regexp_extract_all(s, F.lit("[0-9]+"), F.lit(0)), lambda p: F.coalesce(p.try_cast("int"), F.lit(999)) <= 255)),
        "is_email": flag(x["kind"] == "email"),
        "is_ip": flag(x["kind"] == "ip"),
        "is_card": flag(x["kind"] == "card"),
        "is_phone": flag(x["kind"] == "phone"),
        "cue": flag(before.rlike(CUES)),
        "counter_cue": flag(before.rlike(COUNTER_CUES)),
        "secret_cue": flag(before.rlike(SECRET_CUES)),
        "assigned": flag(before.rlike(r"[=:]\s?[\"']?$")),
        "in_code": flag(before.rlike(r"[\w\]\[./]$") | after.rlike(r"[\[(/]")),
        "glued_before": flag(before.rlike(r"[\w.+-]$")),
        "glued_after": flag(after.rlike(r"\w")),
        "obfuscated": flag(s.rlike(r"[\[({]")),
        "same_digit": flag(d.rlike(r"^(\d)\1*$")),
        "hexadecimal": flag(s.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "both_cases": flag(s.rlike("[a-z]") & s.rlike("[A-Z]")),
        "slashes": F.length(F.regexp_replace(s, "[^/]", "")).cast("double"),
        "joints": F.length(F.regexp_replace(s, "[^_-]", "")).cast("double"),
        "longest_word": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(s, F.lit("[A-Z]?[a-z]+"), F.lit(0)), F.length)), F.lit(0)).cast("double"),
        "variety": F.size(F.array_distinct(F.split(s, ""))) / F.length(s),
        "digit_share": F.length(d) / F.length(s),
    }


def made_spans(h: Column) -> Column:
    """Array of kind, lead, s, label: spans made from a random number, right and
    look-alike ones (1.0 and 0.0) in the same spellings."""
    hexes = lambda k: F.sha2(F.concat_ws(":", h.cast("string"), F.lit(k)), 256)
    number = lambda k, n: F.substring(F.translate(hexes(k), "abcdef", "246813"), 1, n)
    pick = lambda k, of: F.get(F.array(*[F.lit(x) for x in of]), F.pmod(F.xxhash64(h, F.lit(k)), F.lit(len(of))))
    octet = lambda k: F.pmod(F.xxhash64(h, F.lit(k)), F.lit(256)).cast("string")
    part = lambda x, a, n: F.substring(x, a, n)
    fifteen, ten = F.concat(F.lit("4"), number("card", 14)), F.concat(F.lit("5"), number("phone", 9))
    with_check = lambda wrong: F.get(
        F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(fifteen, d.cast("string"))), lambda x: luhn(x) != F.lit(wrong)), F.lit(0)
    )
    fours = lambda x, sign: F.call_function("concat_ws", sign, *[part(x, i, 4) for i in (1, 5, 9, 13)])
    name, host = F.translate(number("name", 6), "0123456789", "aeimnorstu"), F.translate(number("host", 5), "0123456789", "bdfgklmpvz")
    ats = pick("at", (" (at) ", "(at)", "[at]", " [at] ", "{at}"))
    mail = F.concat(name, ats, host, pick("dot", (".", " (dot) ", "[dot]", ".")), pick("top", ("com", "org", "net", "de")))
    phones = [F.concat(F.lit("("), part(ten, 1, 3), F.lit(") "), part(ten, 4, 3), F.lit("-"), part(ten, 7, 4))]
    phones += [F.concat_ws(sign, part(ten, 1, 3), part(ten, 4, 3), part(ten, 7, 4)) for sign in "-. "]
    phones += [F.concat_ws(" ", F.concat(F.lit("00"), part(ten, 2, 2)), part(ten, 4, 3), part(ten, 7, 4))]
    phone = F.get(F.array(*phones), F.pmod(F.xxhash64(h, F.lit("p")), F.lit(len(phones))))
    dots = pick("dots", ("[.]", "(.)", " [.] "))
    ip = F.concat_ws("", *[x for i in range(4) for x in ((dots,) if i else ()) + (octet(f"o{i}"),)])
    over = F.concat_ws("", F.lit("3"), number("v", 2), dots, octet("o1"), dots, octet("o2"), dots, F.lit("9"), number("w", 2))
    mixed = F.translate(F.base64(F.unhex(hexes("s"))), "=+/", "a-_")
    keys = [F.substring(hexes("s"), 1, 40), F.upper(F.substring(hexes("s"), 1, 32)), F.substring(mixed, 1, 32), F.concat(F.lit("pk_"), F.substring(F.regexp_replace(mixed, "[-_]", ""), 1, 28))]
    key = F.get(F.array(*keys), F.pmod(F.xxhash64(h, F.lit("k")), F.lit(len(keys))))
    digest = F.substring(hexes("g"), F.lit(1), F.get(F.array(F.lit(32), F.lit(40), F.lit(64)), F.pmod(F.xxhash64(h, F.lit("g")), F.lit(3))))
    # Names of things: what is written with letters, digits and joints, and is no key.
    letters = {"n1": "abcdefghij", "n2": "klmnoprstu", "n3": "vwmaxyeqzo"}
    said = lambda k: F.substring(F.translate(number(k, 12), "0123456789", letters[k]), F.lit(1), F.pmod(F.xxhash64(h, F.lit(k)), F.lit(7)).cast("int") + 4)
    named = (
        F.concat_ws("/", said("n1"), said("n2"), F.concat(said("n3"), number("n", 2))), F.concat_ws("-", said("n1"), said("n2"), said("n3"), number("n", 4)),
        F.concat_ws("_", said("n1"), said("n2"), F.concat(said("n3"), number("n", 1))), F.concat(said("n1"), F.initcap(said("n2")), F.initcap(said("n3")), number("n", 2)),
        F.concat_ws("-", *[part(hexes("u"), i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
    )
    thing = F.get(F.array(*named), F.pmod(F.xxhash64(h, F.lit("t")), F.lit(len(named))))
    # Three of four are led in by words that no cue names, a look-alike in a hundred by a wrong cue.
    draw = lambda k: F.pmod(F.xxhash64(h, F.lit(k), F.lit("led")), F.lit(100))
    led = lambda k, plain, cued: F.when(draw(k) < 75, pick(k, plain)).otherwise(pick(k + "c", cued))
    misled = lambda k, plain, cued, wrong: F.when(draw(k) == 99, pick(k + "w", wrong)).otherwise(led(k, plain, cued))
    lead, counter = led("lead", LEADS, CUED), misled("counter", COUNTER_LEADS, COUNTERED, CUED)
    stated = led("sl", SECRET_LEADS, SECRET_CUED)
    made = (
        ("email", lead, mail, 1.0), ("email", F.lit(""), F.concat(F.lit("x."), name, F.lit("[at]"), host, F.lit(".size[0]")), 0.0),
        ("email", counter, F.concat(host, F.lit("(at)"), name, F.lit(".length(")), 0.0),
        ("phone", lead, phone, 1.0), ("phone", counter, F.call_function("concat_ws", pick("ps", ("-", ".", " ")), part(ten, 1, 3), part(ten, 4, 3), part(ten, 7, 4)), 0.0), ("phone", misled("c2", COUNTER_LEADS, COUNTERED, CUED), F.concat(phone, F.lit("/"), number("z", 3)), 0.0),
        ("card", lead, fours(with_check(False), F.lit(".")), 1.0), ("card", lead, fours(with_check(True), pick("sign", (".", "-", " "))), 0.0),
        ("card", misled("c3", COUNTER_LEADS, COUNTERED, CUED), with_check(True), 0.0), ("card", lead, number("long", 23), 0.0), ("card", pick("dl", DIGEST_LEADS), digest, 0.0),
        ("ip", lead, ip, 1.0), ("ip", counter, over, 0.0), ("ip", lead, over, 0.0), ("ip", counter, F.concat_ws(".", number("v", 3), octet("o1"), number("w", 3), F.lit("1")), 0.0),
        (SECRET, stated, key, 1.0), (SECRET, pick("dl", DIGEST_LEADS), digest, 0.0), (SECRET, misled("tl", DIGEST_LEADS, SECRET_LEADS, SECRET_CUED), thing, 0.0),
    )
    return F.array(*[F.struct(F.lit(k).alias("kind"), a.alias("lead"), x.alias("s"), F.lit(y).alias("label")) for k, a, x, y in made])


def training_rows(docs: DataFrame) -> DataFrame:
    """Features and label (1.0 or 0.0) of made spans, each between the words at a
    random place of a document. The documents are those with the least hashes, the
    rows then those with the least hashes: both are bounded. `held`: the row's
    document is one of those that thresholds are calibrated on."""
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()
    few = docs.join(checked_broadcast(cut(chosen)), "doc_id", "left_semi")
    at = F.pmod(F.xxhash64(F.lit("place"), "t"), F.length("t") + 1).cast("int")
    left = F.regexp_replace(F.substring(F.col("t"), F.greatest(at - 39, F.lit(1)), F.least(at, F.lit(40))), r"\S+$", "")
    right = F.regexp_replace(F.substring(F.col("t"), at + 1, F.lit(24)), r"^\S+", "")
    rows = few.select("doc_id", text_of().alias("t")).select("doc_id", left.alias("left"), right.alias("right"), F.xxhash64("doc_id", "t").alias("h"))
    # A few short rows, of which much is made: they are dealt out first.
    rows = rows.repartition(docs.sparkSession.sparkContext.defaultParallelism, "h")
    made = rows.select("doc_id", "left", "right", "h", F.posexplode(made_spans(F.col("h"))).alias("no", "m"))
    made = made.filter(F.pmod(F.xxhash64("h", "no"), F.lit(2)) == 0)
    start = F.length("left") + F.length("m.lead")
    made = made.select(
        "doc_id", "h", "no", "m.kind", "m.label", start.alias("from"), (start + F.length("m.s")).alias("to"),
        F.concat("left", "m.lead", "m.s", F.coalesce(F.nullif("right", F.lit("")), F.lit(" "))).alias("u"),
    )
    there = made.select("*", F.explode(candidates(F.col("u"))).alias("x"))
    there = there.filter("NOT x.base AND x.kind = kind AND x.start < to AND `from` < x.`end`")
    values = {k: v.alias(k) for k, v in features(F.col("u"), F.col("x")).items()}
    held = F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(5)) == 0
    return (
        there.select(F.xxhash64("h", "no", "x.start").alias("key"), held.alias("held"), "kind", "label", *values.values())
        .orderBy("key", "kind", "label")
        .limit(SAMPLE_CANDIDATES)
    )


def read_tree(lines: list[str]):
    """A tree from Spark's printed form: a number, or feature, bound, low, high."""
    line = lines.pop(0).strip()
    if line.startswith("Predict:"):
        return float(line.split(":")[1])
    feature, bound = line.removeprefix("If (feature ").rstrip(")").split(" <= ")
    low = read_tree(lines)
    lines.pop(0)  # Else (...)
    return FEATURES[int(feature)], float(bound), low, read_tree(lines)


def tree_column(tree, v: Column) -> Column:
    """A tree as nested conditions on the fields of `v`."""
    if isinstance(tree, float):
        return F.lit(tree)
    feature, bound, low, high = tree
    return F.when(v[feature] <= bound, tree_column(low, v)).otherwise(tree_column(high, v))


class Scorer:
    """Boosted trees and the threshold on their score for each kind."""

    def __init__(self, trees: list, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def to_json(self) -> str:
        return json.dumps({"trees": self.trees, "thresholds": self.thresholds})

    @classmethod
    def from_json(cls, text: str) -> Scorer:
        return cls(**json.loads(text))

    def score(self, values: dict[str, Column]) -> Column:
        """The features go into a struct once; the trees read its fields."""
        made = F.struct(*[values[k].alias(k) for k in FEATURES])
        return let(made, lambda v: reduce(lambda a, b: a + b, [tree_column(t, v) * w for w, t in self.trees], F.lit(0.0)))

    def selects(self, kind: Column, values: dict[str, Column]) -> Column:
        least = F.create_map(*[F.lit(x) for pair in self.thresholds.items() for x in pair])
        return F.coalesce(self.score(values) >= least[kind], F.lit(False))


def learn(docs: DataFrame) -> Scorer:
    """Trees from four fifths of the sample's documents; from the others, for each
    kind, the least threshold with the wanted precision. Without documents, nothing
    is added."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = cut(training_rows(docs)).coalesce(1)
    if {x[0] for x in rows.filter("NOT held").select("label").distinct().collect()} != {0.0, 1.0}:
        return Scorer([], {})
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(vectors.filter("NOT held"))
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees, strict=True):
        lines = [x for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        trees.append((float(weight), read_tree(lines)))
    scorer = Scorer(trees, {})
    # The sample is bounded, and so are its distinct scores.
    held_rows = rows.filter("held").select("kind", scorer.score({k: F.col(k) for k in FEATURES}).alias("score"), "label")
    tally = held_rows.groupBy("kind", "score").agg(F.sum("label"), F.count("*")).orderBy("kind", F.desc("score")).collect()
    good, seen = Counter(), Counter()
    for kind, score, right, n in tally:
        good[kind] += right
        seen[kind] += n
        if good[kind] >= PRECISION * seen[kind]:
            scorer.thresholds[kind] = score
    return scorer


def find_spans(docs: DataFrame, text: str = "text", keep=("doc_id",), scorer: Scorer | None = None) -> DataFrame:
    """The columns `keep`, `_text`, and `spans`: array of kind, start, end, base,
    ordered by kind as listed, then place. Base spans are kept; others if the
    score says so and they don't lie inside or across a base span."""
    if scorer is None:
        scorer = learn(docs.select(F.col(keep[0]).alias("doc_id"), F.col(text).alias("text")))
    rows = docs.select(*keep, text_of(text).alias("_text"))
    rank = F.create_map(*[F.lit(v) for i, k in enumerate((*KINDS, SECRET)) for v in (k, i)])
    tidy = lambda x: F.struct(rank[x["kind"]].alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), x["base"].alias("base"))

    def choose(c: Column) -> Column:
        base = F.filter(c, lambda x: x["base"])

        def add(b: Column) -> Column:
            free = lambda x: ~F.exists(b, lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))
            likely = lambda x: scorer.selects(x["kind"], features(F.col("_text"), x))
            more = F.filter(c, lambda x: ~x["base"] & free(x) & likely(x)) if scorer.thresholds else F.slice(c, 1, 0)
            return F.array_distinct(F.sort_array(F.transform(F.concat(b, more), tidy)))

        return let(base, add)

    return rows.select(*keep, "_text", candidates(F.col("_text")).alias("_c")).select(*keep, "_text", let(F.col("_c"), choose).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns, and the number of all spans."""
    base = lambda k=None: F.filter("spans", lambda x: x["base"] & ((x["kind"] == k) if k else F.lit(True)))
    return found.select(
        "doc_id", *[F.size(base(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base()), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"),
    )


def tallied(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """kind, base, n_candidates, n_accepted: what generators propose and what is found."""
    keyed = docs.select(F.col("doc_id"), text_of().alias("text"))
    proposed = keyed.select(F.explode(candidates(F.col("text"))).alias("x")).groupBy("x.kind", F.col("x.base").alias("base")).agg(F.count("*").alias("n_candidates"))
    found = find_spans(keyed, scorer=scorer).select(F.explode("spans").alias("x")).groupBy("x.kind", F.col("x.base").alias("base")).agg(F.count("*").alias("n_accepted"))
    return proposed.join(found, ["kind", "base"], "left").select("kind", "base", "n_candidates", F.coalesce("n_accepted", F.lit(0)).alias("n_accepted"))


def redact(docs: DataFrame, text: str = "text", scorer: Scorer | None = None) -> DataFrame:
    """`docs` with each span of `text` replaced by its kind in capitals, in
    angle brackets; overlapping spans are replaced together, by the first kind. Without
    a scorer one is learned from `docs`."""
    whole = F.struct(*quoted(docs.columns))
    scorer = learn(docs.select("doc_id", F.col(text).alias("text"))) if scorer is None else scorer
    found = find_spans(docs.select(whole.alias("_row"), F.col(text).alias("text")), keep=("_row",), scorer=scorer)
    t = F.col("_text")
    by_place = F.sort_array(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    step = lambda acc, x: F.struct(
        F.greatest(acc["at"], x["end"]).alias("at"),
        F.when(x["start"] < acc["at"], acc["out"])
        .otherwise(F.concat(acc["out"], F.array(F.substring(t, acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))))
        .alias("out"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t)))
    clean = F.when(F.size("spans") > 0, F.aggregate(by_place, start, step, rest)).otherwise(F.col(f"_row.{text}"))
    return found.select("_row", clean.alias("_clean")).select(
        *[F.col("_clean").alias(c) if c == text else F.col(f"_row.{q}").alias(c) for c, q in zip(docs.columns, quoted(docs.columns), strict=True)]
    )
