"""Secret scans: patterns, and a battery of randomness tests, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut

# Fixed patterns: kind, expression, group of the value, least length of the value.
BASE = (
    (
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        3,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 1, 16),
    ("hex", r"[0-9a-f]{32,}", 1, 32),
)
# Tokens that the battery looks at.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Encodings in the order of inference: expression, alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^[0-9A-Z]+$", DIGITS + UPPER),
    (r"^[0-9A-Za-z]+=*$", DIGITS + UPPER + LOWER),
    (r"^[0-9A-Za-z+/]+=*$", UPPER + LOWER + DIGITS + "+/"),
    (r"^[0-9A-Za-z_-]+=*$", UPPER + LOWER + DIGITS + "-_"),
)
# Lengths from which a stratum of the false-discovery control begins.
STRATA = (20, 32, 64)
# How often neighbouring characters of ordinary tokens change their class, at most.
CHANGE = 0.1
# Share of false discoveries; level at which the battery calls a token not random.
FALSE, REJECT = 0.01, 0.001


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Leftmost non-overlapping matches: struct of start, end (code points) and text of the group.

    Each piece is a match with the text before it since the last one, so lengths add up
    to positions. Only this reads the whole text; the rest reads the pieces.
    """
    whole = rf"(?s)\G.*?({pattern})"
    pieces = F.regexp_extract_all(text, F.lit(whole), F.lit(0))
    start = F.expr("named_struct('at', 0L, 'found', CAST(array() AS array<struct<start:bigint,end:bigint,value:string>>))")

    def step(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        found = F.struct(
            (end - F.length(F.regexp_extract(piece, whole, 1))).alias("start"),
            end.alias("end"),
            F.regexp_extract(piece, whole, group).alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(found)).alias("found"))

    return F.aggregate(pieces, start, step, lambda acc: acc["found"])


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind as listed: array of start, rank, end, kind."""
    text, parts = F.coalesce(text, F.lit("")), []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        parts.append(_spans(_matches(text, pattern, group), rank, kind, least))
    return F.sort_array(F.concat(*parts))


def _spans(found: Column, rank: int, kind: str, least: int = 0) -> Column:
    return F.transform(
        F.filter(found, lambda m: F.length(m["value"]) >= least) if least else found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal distribution, to about 1e-7."""
    x = F.abs(z) / 2**0.5
    t = 1 / (1 + 0.3275911 * x)
    # Fixed coefficients of the rational approximation of erfc.
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def battery(token: Column, alphabet: Column) -> Column:
    """p-value that a token is drawn uniformly from the alphabet: the least of three tests, times three.

    Chi-squared of the symbol counts (upper tail, by the cube-root approximation), runs
    of symbols in the lower and upper half of the alphabet, and serial correlation of
    neighbouring symbols (both two-sided).
    """
    m = F.length(alphabet).cast("double")
    body = F.rtrim(token, F.lit("="))
    n = F.length(body).cast("double")
    squares = F.aggregate(
        F.split(alphabet, ""),
        F.lit(0.0),
        lambda acc, c: acc + F.when(c == "", 0.0).otherwise(F.pow(n - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0))),
    )
    df = m - 1
    chi = F.greatest(m * squares / n - n, F.lit(0.0))
    z_chi = (F.cbrt(chi / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    x = F.transform(F.filter(F.split(body, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c) - 1.0)

    def of_codes(codes: Column) -> Column:
        head, tail = F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1)
        high = F.size(F.filter(codes, lambda v: v >= m / 2)).cast("double")
        low = n - high
        runs = 1 + F.size(F.filter(F.zip_with(head, tail, lambda a, b: (a >= m / 2) != (b >= m / 2)), lambda v: v))
        mean = 2 * high * low / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when(var > 0, (runs - mean) / F.sqrt(var)).otherwise(F.lit(99.0))
        mid, spread = (m - 1) / 2, (m * m - 1) / 12
        products = F.aggregate(F.zip_with(head, tail, lambda a, b: (a - mid) * (b - mid)), F.lit(0.0), lambda s, v: s + v)
        z_serial = products / (spread * F.sqrt(n - 1))
        return F.least(2 * upper_tail(F.abs(z_runs)), 2 * upper_tail(F.abs(z_serial)))

    rest = F.transform(F.array(x), of_codes)[0]
    return F.least(3 * F.least(upper_tail(z_chi), rest), F.lit(1.0))


def _candidates(text: Column) -> Column:
    """Tokens with an inferred encoding and their p-values: start, end, n, p_ordinary, p_random."""
    tokens = F.filter(
        _matches(F.coalesce(text, F.lit("")), TOKEN, 1),
        # A word, also one with a capital or of capitals, has no encoding.
        lambda m: ~m["value"].rlike("^(.?[a-z]*|[A-Z]*|[0-9]*)$"),
    )

    def judged(m: Column) -> Column:
        token = m["value"]
        n = F.length(token).cast("double")
        runs = F.regexp_count(token, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"))
        share = F.least((runs - 1) / (n - 1), F.lit(1 - 1e-9))
        gain = share * F.log(F.greatest(share, F.lit(1e-9)) / CHANGE) + (1 - share) * F.log((1 - share) / (1 - CHANGE))
        alphabet = F.lit(None).cast("string")
        for pattern, symbols in reversed(ENCODINGS):
            alphabet = F.when(token.rlike(pattern), symbols).otherwise(alphabet)
        # Named once by a transform of one element; null where no encoding fits.
        p_random = F.transform(F.array(alphabet), lambda a: battery(token, a))[0]
        return F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.length(token).alias("n"),
            F.when(share <= CHANGE, 1.0).otherwise(F.exp(-(n - 1) * gain)).alias("p_ordinary"),
            F.coalesce(p_random, F.lit(0.0)).alias("p_random"),
        )

    return F.transform(tokens, judged)


def _stratum(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(STRATA[1:], 1):
        out = F.when(n >= least, i).otherwise(out)
    return out


def _levels(found: DataFrame) -> list[float]:
    """Per stratum of length the largest p_ordinary that the false-discovery control accepts.

    The step-up rule runs on counts per distinct p-value, which are as many as there are
    pairs of length and class changes. Three numbers come to the driver.
    """
    tests = found.select(F.explode("tokens").alias("t")).select(_stratum(F.col("t.n")).alias("stratum"), F.col("t.p_ordinary").alias("p"))
    counts = tests.groupBy("stratum", "p").agg(F.count("*").alias("c"))
    within = Window.partitionBy("stratum")
    up_to = within.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("k", F.sum("c").over(up_to)).withColumn("m", F.sum("c").over(within))
    passed = ranked.where(F.col("p") * F.col("m") <= F.col("k") * (FALSE / len(STRATA)))
    levels = {r[0]: r[1] for r in passed.groupBy("stratum").agg(F.max("p")).collect()}
    return [levels.get(i, -1.0) for i in range(len(STRATA))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, and spans, an array of start, rank, end and kind in order of start.

    Spans of the fixed patterns always stay. A token is added, as kind random, if for its
    length its characters change class too often for ordinary writing (step-up control
    of false discoveries in each stratum of length) and no test of the battery refutes
    that it is uniform over the alphabet of its inferred encoding; tokens that overlap a
    span of a fixed pattern are not named twice.

    A null or empty text has no spans. Every row gives one row, whatever its id.
    Texts are read whole and once; only spans and p-values are kept for the second step.
    """
    found = cut(docs.select(F.col(id_col), base_spans(F.col(text_col)).alias("base"), _candidates(F.col(text_col)).alias("tokens")))
    return found.select(id_col, "base", spans_of(F.col("base"), F.col("tokens"), _levels(found)).alias("spans"))


def spans_of(base: Column, tokens: Column, levels: list[float]) -> Column:
    """Fixed patterns' spans and those of the accepted tokens apart from them, in order."""

    def wanted(t: Column) -> Column:
        allowed = F.lit(levels[0])
        for i in range(1, len(STRATA)):
            allowed = F.when(_stratum(t["n"]) == i, levels[i]).otherwise(allowed)
        apart = ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
        return (t["p_ordinary"] <= allowed) & (t["p_random"] >= REJECT) & apart

    return F.sort_array(F.concat(base, _spans(F.filter(tokens, wanted), len(BASE), "random")))


def mask(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of docs; in the texts every span that `scan` finds is replaced by the mark.

    size_col, if there, becomes the length of a text that was changed. Other texts,
    null ones too, stay as they are.
    """
    text = F.col(text_col)
    levels = _levels(cut(docs.select(_candidates(text).alias("tokens")).where(F.size("tokens") > 0)))
    found = docs.withColumn("_base_", base_spans(text)).withColumn("_tokens_", _candidates(text))
    found = found.withColumn("_spans_", spans_of(F.col("_base_"), F.col("_tokens_"), levels))
    hit = F.size("_spans_") > 0
    out = {text_col: F.when(hit, redact(text, F.col("_spans_"), mark)).otherwise(text)}
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        out[size_col] = F.when(hit, F.length(out[text_col]).cast(kind)).otherwise(F.col(size_col))
    return found.withColumns(out).select(docs.columns)


def span_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per kind, the hash of the fixed patterns' spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind, *_ in BASE]
    return found.select(
        id_col, *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by the mark."""
    merged = F.aggregate(
        spans,
        F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] <= F.element_at(acc, -1)["end"]),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    out = F.aggregate(
        merged,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), F.lit(mark)).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.lit(2**31 - 1))),
    )
    return F.when(F.size(spans) > 0, out).otherwise(text)
