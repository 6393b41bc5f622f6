"""Operator 8 [native]: personal data by patterns, checksums and context.

Regular expressions propose spans, validators confirm them (octets for ip, Luhn for card,
a count of digits for phone, the remainder by 97 for iban), and words near a span raise
its score.  The four base kinds keep every confirmed span; the method adds iban spans.
An iban is proposed by its country and two digits at the edge of a word, runs for the fixed
length of that country (single spaces between don't count) and must end at the edge of a
word, so what follows it doesn't matter; none begins inside the one before.  A threshold on
the score decides on the added kind; base spans stay whatever their score.

Spark's functions give the matches of a pattern and the pieces between them, whose
lengths give the places: all is row-local, without shuffle or Python.  Patterns start at
the edge of a run of their characters (or where the last match ended) and don't give
back what they took, so a long run is read once and not from each of its characters.

Null and empty texts have no spans, an empty table gives no rows, very long texts are searched
whole.  Rows are judged one by one, whatever their id.  Other columns are kept as they are by
``find`` and ``redact``, whatever their names: what is made on the way is a single column
with a name that is free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "[A-Za-z0-9._%+-]"

#: Fixed lengths of account numbers by country.
ACCOUNT_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30}

#: Fixed patterns of the kinds, in their order; what a text must contain to be searched.
PATTERNS = {
    "email": (f"(?:\\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", "."),
    "card": ("[0-9](?:[\\x20-]?[0-9])++", None),
    "phone": ("\\+[0-9][\\x20().0-9-]+[0-9]", "+"),
    "iban": (f"(?<![A-Za-z0-9_])(?:{'|'.join(ACCOUNT_LENGTHS)})[0-9]{{2}}(?=(?:\\x20?[A-Z0-9]){{11}})", None),  # what may begin one
}
BASE = ["email", "ip", "card", "phone"]

#: Fixed words that make a kind likelier when they stand near, and the score without them.
CONTEXT = {
    "email": ("mail|contact|write|address|e-mail", 0.9),
    "ip": ("ip|host|server|address|login", 0.6),
    "card": ("card|visa|credit|debit|payment|karte|tarjeta|carte", 0.7),
    "phone": ("phone|call|tel|mobile|fax|telefon|teléfono", 0.6),
    "iban": ("iban|account|bank|konto|compte|cuenta", 0.8),
}
NEAR = 40
#: Least score of the added kinds' spans.
LEAST_SCORE = 0.5
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

_NONE = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _number(c: Column) -> Column:
    """A character of an account number as a number (letters count from 10)."""
    return F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)


def _account_end(text: Column, head: Column) -> Column:
    """Where the account number that begins with ``head`` ends, null if it doesn't pass: the number,
    its first four characters moved to the end, leaves 1 when divided by 97."""
    kind = "struct<rem:int,n:int,at:int,on:boolean,gap:boolean,best:int,wanted:int>"
    value = head["value"]
    lengths = F.create_map(*[F.lit(x) for pair in ACCOUNT_LENGTHS.items() for x in pair])
    wanted = F.element_at(lengths, F.substring(value, 1, 2)) - 4
    first = (_number(F.substring(value, 1, 1)) * 100 + _number(F.substring(value, 2, 1))) * 100 + F.substring(value, 3, 2).cast("int")
    zero = F.struct(F.lit(0).alias("rem"), F.lit(0).alias("n"), head["end"].alias("at"), F.lit(True).alias("on"),
                    F.lit(False).alias("gap"), F.lit(None).cast("int").alias("best"), wanted.alias("wanted")).cast(kind)

    def step(acc: Column, c: Column) -> Column:
        own, space = c.between("A", "Z") | c.between("0", "9"), c == " "
        ends = acc["on"] & ~acc["gap"] & ~own & ~c.between("a", "z") & (c != "_") & (acc["n"] == acc["wanted"])
        number = _number(c)
        return F.struct(
            F.when(~own, acc["rem"]).when(number > 9, (acc["rem"] * 100 + number) % 97)
            .otherwise((acc["rem"] * 10 + number) % 97).alias("rem"),
            (acc["n"] + own.cast("int")).alias("n"), (acc["at"] + 1).alias("at"),
            (acc["on"] & (own | (space & ~acc["gap"]))).alias("on"), space.alias("gap"),
            F.when(ends & ((acc["rem"] * 1_000_000 + first) % 97 == 1), acc["at"]).otherwise(acc["best"]).alias("best"),
            acc["wanted"].alias("wanted")).cast(kind)
    # at most 29 characters with a space before each, one that shows the edge, and one for the end of the text
    after = F.concat(F.substr(text, head["end"] + 1, F.lit(61)), F.lit("\n"))
    return F.aggregate(F.split(after, ""), zero, step, lambda acc: acc["best"])


def _accounts(text: Column, heads: Column) -> Column:
    """Account numbers from their proposed first characters; of those that overlap the first."""
    whole = F.filter(F.transform(heads, lambda h: F.struct(
        h["start"].alias("start"), _account_end(text, h).alias("end"), h["value"].alias("value"))),
        lambda s: s["end"].isNotNull())
    return F.aggregate(whole, F.array().cast(_NONE), lambda out, s: F.when(
        (F.size(out) > 0) & (s["start"] < F.try_element_at(out, F.lit(-1))["end"]), out).otherwise(F.concat(out, F.array(s))).cast(_NONE))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$")
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(16, 19), luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _checker(kind: str):
    return lambda span: _valid(kind, span["value"])


def _proposals(found: Column, pieces: Column) -> Column:
    """Matches with their places (code points, end exclusive), from the pieces around them."""
    kind = "struct<at:int,out:array<struct<start:int,end:int,value:string>>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_NONE).alias("out")).cast(kind)
    pairs = F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["p"])
        end = start + F.length(pair["m"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out")).cast(kind)
    return F.aggregate(pairs, zero, step, lambda acc: acc["out"])


def _score(kind: str, text: Column, span: Column) -> Column:
    words, score = CONTEXT[kind]
    near = F.substring(text, F.greatest(span["start"] - NEAR, F.lit(0)) + 1,
                       span["end"] - F.greatest(span["start"] - NEAR, F.lit(0)) + NEAR)
    return F.when(near.rlike(f"(?iu)(?:^|[^A-Za-z0-9_])(?:{words})"), F.lit(min(1.0, score + 0.1))).otherwise(F.lit(score))


def _scored(kind: str, text: Column):
    return lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end"),
                                 _score(kind, text, span).alias("score"))


def _free(columns: list[str], name: str) -> str:
    """``name``, longer by underscores until no column has it (names don't tell case apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _found(docs: DataFrame, text: Column, out: str, least_score: float) -> DataFrame:
    """``docs`` with one struct column that has a field for each kind: its spans with start, end, score."""
    step, fields = {k: _free([*docs.columns, out], f"{out}{k}") for k in ("m", "p", "s")}, list(PATTERNS)
    found, pieces, spans = [], [], []
    for kind, (pattern, sign) in PATTERNS.items():
        some = F.contains(text, F.lit(sign)) if sign else text.rlike("[0-9]")
        matches = F.col(f"{step['m']}.{kind}")
        found.append(F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(kind))
        pieces.append(F.when(F.size(matches) > 0, F.split(text, pattern, -1)).alias(kind))
        proposed = _proposals(matches, F.col(f"{step['p']}.{kind}"))
        confirmed = _accounts(text, proposed) if kind == "iban" else F.filter(proposed, _checker(kind))
        spans.append(F.coalesce(F.when(F.size(matches) > 0, confirmed), F.array().cast(_NONE)).alias(kind))
    own = docs.withColumn(step["m"], F.struct(*found)).withColumn(step["p"], F.struct(*pieces)).withColumn(
        step["s"], F.struct(*spans)).drop(step["m"], step["p"])
    scored = {k: F.transform(F.col(f"{step['s']}.{k}"), _scored(k, text)) for k in fields}
    return own.withColumn(out, F.struct(*[
        (scored[k] if k in BASE else F.filter(scored[k], lambda s: s["score"] >= least_score)).alias(k) for k in fields])) \
        .drop(step["s"])


def find(docs: DataFrame, text_col: str = "text", out: str = "pii", least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with a column ``out`` that has a field for each kind: its spans with start, end and score.
    A caller's column of that name is replaced."""
    name = _free(docs.columns, out)
    own = _found(docs, F.coalesce(F.col(text_col).cast("string"), F.lit("")), name, least_score)
    return own if name == out else own.drop(out).withColumnRenamed(name, out)


def _each(kinds: list[str], out: str, made) -> Column:
    """The spans of all kinds in one array, each as ``made(kind, span)``."""
    def of(kind: str):
        return lambda span: made(kind, span)
    return F.concat(*[F.transform(F.col(f"{out}.{k}"), of(k)) for k in kinds])


def _written(kinds: list[str], out: str) -> Column:
    return F.array_join(_each(kinds, out, lambda kind, s: F.concat_ws(
        ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))), ",")


def written_scores(scored: str | Column) -> Column:
    """``scored`` as text: kind, start, end and the score in percent."""
    return F.array_join(F.transform(scored, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"),
        F.round(s["score"] * 100).cast("int").cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """One row for each document: doc_id, a count for each base kind, base_sha256, spans, and
    ``scored``, all spans with their kinds and scores."""
    own = find(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), least_score=least_score)
    scored = _each(list(PATTERNS), "pii", lambda kind, s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))
    return own.select("doc_id", *[F.size(f"pii.{k}").cast("long").alias(f"n_{k}") for k in BASE],
                      F.sha2(_written(BASE, "pii"), 256).alias("base_sha256"),
                      _written(list(PATTERNS), "pii").alias("spans"), scored.alias("scored"))


def redact(docs: DataFrame, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets; of spans that
    overlap the first gives the name.  Null texts stay null."""
    text, out = F.col(text_col), _free(docs.columns, "pii")
    own = _found(docs, F.coalesce(text.cast("string"), F.lit("")), out, least_score)
    spans = F.array_sort(_each(list(PATTERNS), out, lambda kind, s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(f"<{kind.upper()}>").alias("tag"))))
    kind = "struct<at:int,out:string>"

    def step(acc: Column, s: Column) -> Column:
        clean = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], clean, s["tag"]))
            .otherwise(acc["out"]).alias("out")).cast(kind))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast(kind)
    listed = _free([*docs.columns, out], "spans")
    cleaned = F.aggregate(listed, zero, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
    return own.withColumn(listed, spans).select(*[
        F.when(F.size(listed) > 0, cleaned).otherwise(text).alias(c) if c == text_col else F.col(c) for c in docs.columns])
