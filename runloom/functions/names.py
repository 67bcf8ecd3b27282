"""Column expressions over file, run, sample and metadata names."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tag of one index or several, which `-` or `+` joins.
TAG = "(?:[ACGTN-]+|[ACGTN+]+)"
#: Fields of a name, joined by `_`, in their order from the right: set, read, lane, tag or sample number.
FIELDS = (("set", "[0-9]{3}", 1), ("read", "[RI][0-9]", 2), ("lane", "L[0-9]{3}", 3), ("tag", TAG, 4), ("number", "S[0-9]+", 4))
#: `<sample>[.<barcode>].r<n>`
DOTTED = rf"^(.+?)(?:\.({TAG}))?(?:\.r([0-9]))?$"
#: `SRR…` or `ERR…`, with `_1` or `_2`
ACCESSION = r"^([SE]RR[0-9]+)(?:_([12]))?$"


def basename(path: Column) -> Column:
    """Without directory and without FASTQ or BAM extensions."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(\.(fastq|fq|bam))?(\.gz|\.bz2)?$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"((?:\.(?:fastq|fq|bam))?(?:\.gz|\.bz2)?)$", 1)


def compression(path: Column) -> Column:
    return _given(F.regexp_extract(path, r"\.(gz|bz2)$", 1))


def file_type(path: Column) -> Column:
    kind = _given(F.regexp_extract(path, r"\.(fastq|fq|bam)(?:\.gz|\.bz2)?$", 1))
    return F.when(kind == "fq", "fastq").otherwise(kind)


def _given(x: Column) -> Column:
    return F.nullif(x, F.lit(""))


def peeled(name: Column) -> Column:
    """What a name's fields are, taken off one by one from the right: a field is kept in
    mind if it is of a kind that comes before those already seen; the first that is
    not, and all before it, are the sample. The last field left is never taken off."""
    fields = F.split(name, "_")

    def step(seen: Column, field: Column) -> Column:
        kinds = [(k, field.rlike(f"^{form}$"), rank) for k, form, rank in FIELDS]
        rank = reduce(lambda rest, kind: F.when(kind[1], kind[2]).otherwise(rest), reversed(kinds), F.lit(0))
        fits = (rank > seen["rank"]) & (seen["taken"] + 1 < F.size(fields))
        return F.struct(
            F.when(fits, rank).otherwise(F.lit(9)).alias("rank"), (seen["taken"] + fits.cast("int")).alias("taken"),
            *[F.when(fits & is_kind, field).otherwise(seen[k]).alias(k) for k, is_kind, _ in kinds],
        )

    start = F.struct(F.lit(0).alias("rank"), F.lit(0).alias("taken"), *[F.lit(None).cast("string").alias(k) for k, _, _ in FIELDS])
    sample = lambda seen: F.array_join(F.slice(fields, 1, F.size(fields) - seen["taken"]), "_").alias("sample")
    return F.aggregate(F.reverse(fields), start, step, lambda seen: F.struct(sample(seen), *[seen[k].alias(k) for k, _, _ in FIELDS]))


def illumina_attrs(path: Column) -> dict[str, Column]:
    seen = peeled(basename(path))
    number = lambda k, at: F.substring(seen[k], at, 9).cast("int")
    return {
        "sample_name": _given(seen["sample"]), "sample_number": number("number", 2), "barcode_sequence": seen["tag"], "lane_number": number("lane", 2),
        "read_number": number("read", 2), "set_number": number("set", 1), "is_index_read": F.coalesce(F.substring(seen["read"], 1, 1) == "I", F.lit(False)),
    }


def dotted_attrs(path: Column) -> dict[str, Column]:
    name = basename(path)
    part = lambda i: _given(F.regexp_extract(name, DOTTED, i))
    return {"sample_name": part(1), "barcode_sequence": part(2), "read_number": part(3).cast("int")}


def accession_attrs(path: Column) -> dict[str, Column]:
    """Without a number the read is 1, implied."""
    name = basename(path)
    read = _given(F.regexp_extract(name, ACCESSION, 2)).cast("int")
    known = name.rlike(ACCESSION)
    return {
        "sample_name": _given(F.regexp_extract(name, ACCESSION, 1)),
        "read_number": F.when(known, F.coalesce(read, F.lit(1))),
        "implicit_read": known & read.isNull(),
    }


def canonical_and_extras(path: Column) -> tuple[Column, Column]:
    """The longest part from the left whose last field tells something (a set, read,
    lane, tag or sample number, or a dotted tag or read), and what follows it; the
    whole name, if there is no such part."""
    name = basename(path)
    fields = F.split(name, "_")
    fewer = F.sequence(F.size(fields), F.lit(1), F.lit(-1))
    plain = rf"^[^.]+_(?:{'|'.join(form for _, form, _ in FIELDS)})$"
    dotted = rf"^.+\.(?:{TAG}|r[0-9])$"
    parts = F.transform(fewer, lambda n: F.array_join(F.slice(fields, F.lit(1), n), "_"))
    canonical = F.coalesce(F.get(F.filter(parts, lambda x: x.rlike(plain) | x.rlike(dotted)), F.lit(0)), name)
    return canonical, _given(F.substring(name, F.length(canonical) + 1, F.length(name)))


def rebuilt(sample, number, barcode, lane, read, set_number, is_index) -> Column:
    """A name from its attributes; what is null drops out."""
    tag = lambda form, x: F.when(x.isNotNull(), F.format_string(form, x))
    letter = F.when(is_index, F.lit("I")).otherwise(F.lit("R"))
    return F.concat_ws(
        "_", sample, tag("S%d", number), barcode, tag("L%03d", lane),
        F.when(read.isNotNull(), F.concat(letter, read.cast("string"))), tag("%03d", set_number),
    )


def changed(path: Column, **new) -> Column:
    """The name with some attributes changed, by name; None drops one."""
    a = illumina_attrs(path) | {k: F.lit(v) if v is not None else F.lit(None).cast("int") for k, v in new.items()}
    return rebuilt(*[a[k] for k in ("sample_name", "sample_number", "barcode_sequence", "lane_number", "read_number", "set_number", "is_index_read")])


def bam_name(path: Column) -> Column:
    """The name without its read number."""
    return changed(path, read_number=None)


def natural_key(name: Column) -> Column:
    """Texts and padded numbers in turn; arrays sort field by field."""
    parts = F.regexp_extract_all(name, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    padded = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), F.lpad(p, 20, "0")).otherwise(p))
    return F.when(name.rlike("^[0-9]"), F.concat(F.array(F.lit("")), padded)).otherwise(padded)


RUN_NAME = r"^([0-9]{6,8})_([^_]+)_([0-9]+)_([AB]?)(.+)$"


def run_parts(run: Column) -> dict[str, Column]:
    part = lambda i: _given(F.regexp_extract(run, RUN_NAME, i))
    date = F.when(F.length(part(1)) == 6, F.try_to_timestamp(part(1), F.lit("yyMMdd"))).otherwise(F.try_to_timestamp(part(1), F.lit("yyyyMMdd")))
    return {"date_stamp": part(1), "run_date": date.cast("date"), "instrument": part(2), "run_number": part(3).cast("int"), "flow_cell_id": part(5)}


def run_id(run: Column, platform: Column, facility: Column, analysis: Column) -> Column:
    """`PLATFORM_DATE[/RUN]#FACILITY[.ANALYSIS]`; the instrument's run number only
    if it differs from the facility's. A name that can't be parsed has no date."""
    p = run_parts(run)
    made_by = F.coalesce(F.upper(platform), p["instrument"])
    head = F.when(made_by.isNull(), run).otherwise(F.concat(made_by, F.lit("_"), F.coalesce(p["date_stamp"], run)))
    number = F.when(p["run_number"].isNotNull() & ~p["run_number"].eqNullSafe(facility), F.concat(F.lit("/"), p["run_number"].cast("string")))
    none = F.lit("")
    return F.concat(
        head, F.coalesce(number, none), F.coalesce(F.concat(F.lit("#"), facility.cast("string")), none),
        F.coalesce(F.concat(F.lit("."), analysis.cast("string")), none),
    )


def run_reference(run_id_: Column, flow_cell_mode: Column) -> Column:
    """A run ID, and the flow cell's mode if it is known."""
    return F.concat(run_id_, F.coalesce(F.concat(F.lit("_"), _given(flow_cell_mode)), F.lit("")))


def sample_reference(ref: Column) -> dict[str, Column]:
    """`[RUN][:PROJECT[/SAMPLE]]`; with `#` and no colon it is a run alone."""
    colon, hashed = F.contains(ref, F.lit(":")), F.contains(ref, F.lit("#"))
    run = F.when(colon, F.substring_index(ref, ":", 1)).when(hashed, ref)
    rest = F.when(colon, F.regexp_extract(ref, "^[^:]*:(.*)$", 1)).when(~hashed, ref)
    return {"run": _given(run), "project": _given(F.substring_index(rest, "/", 1)), "sample": _given(F.when(F.contains(rest, F.lit("/")), F.regexp_extract(rest, "^[^/]*/(.*)$", 1)))}


def organisms(listed: Column) -> Column:
    """Split at commas, lower case, white space to `_`, `_` stripped."""
    one = lambda x: F.btrim(F.regexp_replace(F.lower(F.trim(x)), r"\s+", "_"), F.lit("_"))
    return F.transform(F.split(listed, ","), one)


def label_of(key: Column) -> Column:
    """A metadata key as a label: underscores to spaces; capitalised only if all
    lower case."""
    spaced = F.replace(key, F.lit("_"), F.lit(" "))
    first = F.concat(F.upper(F.substring(spaced, 1, 1)), F.substring(spaced, F.lit(2), F.length(spaced)))
    return F.when(F.lower(key) == key, first).otherwise(spaced)


def key_of(label: Column) -> Column:
    return F.lower(F.replace(label, F.lit(" "), F.lit("_")))


def composite(delimiter: str, *columns: Column) -> Column:
    """Several columns joined; nulls and empty ones are skipped."""
    return F.concat_ws(delimiter, *[_given(c) for c in columns])


def has_invalid_characters(text: Column) -> Column:
    """Codes above 127 or below 32, but for newline and tab."""
    return text.rlike(r"[^\x20-\x7F\n\t]")


def strand_label(forward: Column, reverse: Column) -> Column:
    ratio = F.try_divide(forward, reverse)
    return (
        F.when((forward == 0) & (reverse == 0), "undetermined")
        .when((reverse == 0) | (ratio > 5), "forward")
        .when(ratio < 0.2, "reverse")
        .otherwise("unstranded?")
    )


def strand_protocol(forward: Column, reverse: Column, undetermined: Column) -> Column:
    ratio = forward / (reverse + 0.001)
    return (
        F.when(forward.isNull() | reverse.isNull() | undetermined.isNull(), F.lit(None).cast("string"))
        .when((undetermined > forward) & (undetermined > reverse), "none")
        .when(ratio < 0.2, "reverse")
        .when(ratio > 5, "forward")
        .otherwise("none")
    )


def glob_like(name: Column, pattern: str) -> Column:
    """`*`, `?`, `[…]` and `[!…]`, over the whole name."""
    form, at = "", 0
    while at < len(pattern):
        c = pattern[at]
        end = pattern.find("]", at + (3 if pattern[at + 1 : at + 2] == "!" else 2)) if c == "[" else -1
        if end > 0:
            inside, negated = pattern[at + 1 : end], pattern[at + 1] == "!"
            form += f"[{'^' if negated else ''}{re.sub(r'([\\\[\]^&])', r'\\\1', inside[negated:])}]"
            at = end
        else:
            form += "(?s:.*)" if c == "*" else "(?s:.)" if c == "?" else re.escape(c)
        at += 1
    return name.rlike(f"^(?:{form})\\z")


class CustomNames:
    """Names by a pattern of `{SAMPLE}`, `{READ}` and `*` around literal parts, without
    extension. Called with a path it gives the sample and the read number, null where the
    name doesn't fit; `renamed` and `bam_name` rebuild the name, with what the wildcards
    held. Sample and wildcards are as long as they can be, from left to right; reads
    are 1 to 3. Names of BAM files have no read, nor the `_R` or `_` before it; other
    separators that would end such a name go too."""

    READ = "[1-3]"

    def __init__(self, pattern: str):
        tokens = [t for t in re.split(r"(\{[^}]*\}|\*)", pattern) if t]
        unknown = [t for t in tokens if t.startswith("{") and t not in ("{SAMPLE}", "{READ}")]
        if unknown:
            raise ValueError(f"unknown marks: {', '.join(unknown)}")
        self.tokens, self.without_read = tokens, []
        for t in tokens:
            if t != "{READ}":
                self.without_read.append(t)
            elif self.without_read and self._literal(self.without_read[-1]):
                self.without_read[-1] = re.sub("(_R|_)$", "", self.without_read[-1])
        if self.without_read and self._literal(self.without_read[-1]):
            self.without_read[-1] = self.without_read[-1].rstrip("_-.")

    @staticmethod
    def _literal(token: str) -> bool:
        return token not in ("{SAMPLE}", "{READ}", "*")

    def _form(self, tokens: list[str]) -> str:
        parts = {"{SAMPLE}": "(.+)", "{READ}": f"({self.READ})", "*": "(.*)"}
        return f"^{''.join(parts.get(t) or re.escape(t) for t in tokens)}$"

    def _read(self, path: Column, tokens: list[str]) -> list[tuple[str, Column]]:
        """Each token and what it stands for in the name."""
        name, form, marks, out = basename(path), self._form(tokens), 0, []
        for t in tokens:
            marks += not self._literal(t)
            out.append((t, F.lit(t) if self._literal(t) else F.regexp_extract(name, form, marks)))
        return out

    def _value(self, path: Column, mark: str) -> Column:
        found = lambda tokens: next((c for t, c in self._read(path, tokens) if t == mark), F.lit(""))
        return _given(F.when(file_type(path) == "bam", found(self.without_read)).otherwise(found(self.tokens)))

    def __call__(self, path: Column) -> dict[str, Column]:
        return {"sample_name": self._value(path, "{SAMPLE}"), "read_number": self._value(path, "{READ}").cast("int")}

    def _rebuilt(self, path: Column, tokens: list[str], read: Column) -> Column:
        def of(own: list[str]) -> Column:
            held = [c for t, c in self._read(path, own) if not self._literal(t) and t != "{READ}"]
            parts = [F.lit(t) if self._literal(t) else read.cast("string") if t == "{READ}" else held.pop(0) for t in tokens]
            return F.when(basename(path).rlike(self._form(own)), F.concat(*parts)).otherwise(basename(path))

        return F.when(file_type(path) == "bam", of(self.without_read)).otherwise(of(self.tokens))

    def renamed(self, path: Column, read: Column | None = None) -> Column:
        """The name with another read, or its own; without any it is the BAM name. A
        name that doesn't fit is kept."""
        read = self._value(path, "{READ}") if read is None else read
        return F.coalesce(self._rebuilt(path, self.tokens, read), self.bam_name(path))

    def bam_name(self, path: Column) -> Column:
        return self._rebuilt(path, self.without_read, F.lit(""))


def custom_attrs(path: Column, pattern: str) -> dict[str, Column]:
    """Sample and read number by a pattern of `CustomNames`."""
    return CustomNames(pattern)(path)
