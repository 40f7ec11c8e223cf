"""Secret scans: patterns, and a battery of randomness tests under false-discovery control
(DataFrame functions only)."""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import table, text_or_empty, written

#: kinds of the base patterns in the order in which equal starts are listed; (?i) folds A-Z only
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (("assign", ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]{32,}"))
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16
#: what the battery judges: words of the alphabets below that no base pattern has taken
TOKEN, MIN_TOKEN = "[A-Za-z0-9+/_-]{16,}", 16
#: share of wrong finds that is allowed among the finds of a length class
FALSE_DISCOVERIES = 0.05
#: lower ends of the length classes; each has its own false-discovery control
LENGTHS = (16, 20, 24, 32, 48, 96)
#: a word counts as structured from these deviations on: chi-squared over n, share of the expected
#: changes of class, serial correlation
UNEVEN, CHANGES, SERIAL = 0.5, 0.5, 0.5
#: evidence is counted in tenths of powers of ten, rounded down, up to this
MAX_BIN = 300

_D, _U, _L = string.digits, string.ascii_uppercase, string.ascii_lowercase
#: encodings, smallest alphabet first: pattern, alphabet, chance that neighbours differ in class
ENCODINGS = (
    ("^[0-9]+$", _D),
    ("^[0-9a-f]+$", _D + "abcdef"),
    ("^[0-9A-F]+$", _D + "ABCDEF"),
    ("^[A-Z2-7]+$", _U + "234567"),
    ("^[0-9a-z]+$", _D + _L),
    ("^[0-9A-Z]+$", _D + _U),
    ("^[0-9A-Za-z]+$", _D + _U + _L),
    ("^", _U + _L + _D + "+/"),
)


def char_classes(alphabet: str) -> str:
    """The class of each character of an alphabet; ten digits alone fall into low and high ones."""
    if alphabet == _D:
        return "l" * 5 + "h" * 5
    return "".join("d" if c in _D else "u" if c in _U else "l" if c in _L else "o" for c in alphabet)


def change_chance(alphabet: str) -> float:
    classes = char_classes(alphabet)
    return 1 - sum((classes.count(k) / len(classes)) ** 2 for k in set(classes))


def _longs() -> Column:
    return F.array().cast("array<bigint>")


def running_sums(lengths: Column, chunk: int = 256) -> Column:
    """For each element the sum of those before it. Arrays grow by copying, so the sums are taken
    in chunks and over the chunks: a text of a million matches stays cheap."""
    def sums_from(values, base):
        grown = F.aggregate(
            values, F.struct(base.alias("total"), _longs().alias("at")),
            lambda acc, x: F.struct((acc["total"] + x).alias("total"),
                                    F.concat(acc["at"], F.array(acc["total"])).alias("at")))
        return grown["at"]

    zero = F.lit(0).cast("bigint")
    last = F.floor((F.size(lengths) - 1) / chunk).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lengths, i * chunk + 1, F.lit(chunk)))
    sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
    return F.when(F.size(lengths) > 0,
                  F.flatten(F.zip_with(chunks, sums_from(sums, zero), sums_from))).otherwise(_longs())


def _length(c: Column) -> Column:
    return F.char_length(c).cast("bigint")


def with_matches(df: DataFrame, text: str, pattern: str, out: str, value: bool = False) -> DataFrame:
    """``df`` with ``out``: the pattern's matches in ``text``, leftmost first, as array<struct<start,
    end, match, value, lead>> (places in code points, end exclusive; ``value``: group 2; ``lead``:
    the text since the match before), and ``out``_rest, the text after the last one.

    The pieces between matches and the matches themselves give the places; texts without a
    match pass the pattern once.
    """
    body, some = F.col(text), F.size("__pieces") > 1
    none = F.array().cast("array<string>")
    df = df.withColumn("__pieces", F.split(body, pattern, -1))
    df = df.withColumn("__m", F.when(some, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("__v", F.when(some, F.regexp_extract_all(body, F.lit(pattern), F.lit(2)))
                       .otherwise(none) if value else F.col("__m"))
    lengths = F.zip_with(F.slice("__pieces", F.lit(1), F.size("__m")), "__m", lambda p, m: _length(p) + _length(m))
    df = df.withColumn("__at", F.when(some, running_sums(lengths)).otherwise(_longs()))
    parts = F.arrays_zip(F.slice("__pieces", F.lit(1), F.size("__m")).alias("p"), F.col("__m").alias("m"),
                         F.col("__v").alias("v"), F.col("__at").alias("at"))
    start = lambda x: x["at"] + _length(x["p"])
    return (df.withColumn(out, F.transform(parts, lambda x: F.struct(
        start(x).alias("start"), (start(x) + _length(x["m"])).alias("end"), x["m"].alias("match"),
        x["v"].alias("value"), x["p"].alias("lead"))))
        .withColumn(f"{out}_rest", F.element_at("__pieces", -1)).drop("__pieces", "__m", "__v", "__at"))


def right_match(kind: str, x: Column) -> Column:
    if kind == "assign":
        return F.char_length(x["value"]) >= ASSIGN_VALUE
    if kind == "access":
        return F.char_length(x["match"]) >= ACCESS_LENGTH
    return F.lit(True)


def blanked(matches: str, kind: str) -> Column:
    """The text of ``matches`` with as many blanks in place of each right match."""
    pieces = F.transform(matches, lambda x: F.concat(x["lead"], F.when(
        right_match(kind, x), F.repeat(F.lit(" "), F.char_length(x["match"]))).otherwise(x["match"])))
    return F.concat(F.array_join(pieces, ""), F.col(f"{matches}_rest"))


def battery(tokens: Column) -> Column:
    """array<struct<start, end, length, bin>> of tokens: ``bin`` is the evidence, in tenths of powers
    of ten, against a token being structured.

    The encoding is the smallest alphabet that holds the token. Three tests against uniform,
    independent characters: chi-squared over about n/4 equal stretches of the alphabet, the
    number of runs of character classes, and the correlation of neighbours. Each is turned
    round into a test of "structured": how far its statistic stays below what the least
    deviation that counts as structure (UNEVEN, CHANGES, SERIAL) would bring at this length, in
    standard deviations. The three are added (Stouffer), and exp(-z*z/2)/2 bounds the normal tail.
    """
    def pick(body, choose):
        out = F.lit(choose(ENCODINGS[-1][1]))
        for pattern, alphabet in reversed(ENCODINGS[:-1]):
            out = F.when(body.rlike(pattern), F.lit(choose(alphabet))).otherwise(out)
        return out

    coded = F.transform(tokens, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.translate(x["match"], "-_", "+/").alias("body"),
        _length(x["match"]).cast("double").alias("n")))
    coded = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["body"].alias("body"), x["n"].alias("n"),
        pick(x["body"], str).alias("alphabet"), pick(x["body"], change_chance).alias("c")))

    def classes(x):
        other = F.translate(x["body"], _D + _U + _L + "+/", "d" * 10 + "u" * 26 + "l" * 26 + "oo")
        digits = F.translate(x["body"], _D, char_classes(_D))
        return F.when(x["alphabet"] == _D, digits).otherwise(other)

    coded = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["n"].alias("n"), x["c"].alias("c"),
        F.length(x["alphabet"]).cast("double").alias("m"),
        F.length(F.regexp_replace(classes(x), r"(.)\1*", "x")).cast("double").alias("runs"),
        F.transform(F.split(x["body"], ""), lambda ch: (F.instr(x["alphabet"], ch) - 1).cast("double")).alias("v")))
    bins = lambda x: F.least(x["m"], F.floor(x["n"] / 4).cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
    coded = F.transform(coded, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["n"].alias("n"), x["c"].alias("c"), x["m"].alias("m"),
        x["runs"].alias("runs"), bins(x).alias("b"), x["v"].alias("v"), (total(x["v"]) / x["n"]).alias("mean"),
        F.transform(x["v"], lambda y: F.floor(y * bins(x) / x["m"]).cast("int")).alias("bin")))

    def chi(x):
        # a stretch k of the alphabet holds ceil((k+1)m/b) - ceil(km/b) of its m characters
        def one(k):
            k = k.cast("double")
            expected = x["n"] * (F.ceil((k + 1) * x["m"] / x["b"]) - F.ceil(k * x["m"] / x["b"])).cast("double") / x["m"]
            seen = F.size(F.filter(x["bin"], lambda y: y == k)).cast("double")
            return (seen - expected) * (seen - expected) / expected
        return total(F.transform(F.sequence(F.lit(0), x["b"].cast("int") - 1), one))

    def serial(x):
        n = F.size(x["v"])
        pairs = F.zip_with(F.slice(x["v"], F.lit(1), n - 1), F.slice(x["v"], F.lit(2), n - 1),
                           lambda a, b: (a - x["mean"]) * (b - x["mean"]))
        spread = total(F.transform(x["v"], lambda a: (a - x["mean"]) * (a - x["mean"])))
        return F.when(spread > 0, F.abs(total(pairs)) / spread).otherwise(1.0)

    def z(x):
        n = x["n"]
        shift, df = n * UNEVEN, x["b"] - 1
        even = (chi(x) - (df + shift)) / F.sqrt(2 * (df + 2 * shift))
        changes = (n - 1) * x["c"]
        runs = (F.abs(x["runs"] - 1 - changes) - CHANGES * changes) / F.sqrt(changes * (1 - x["c"]))
        return (even + runs + (serial(x) - SERIAL) * F.sqrt(n)) / math.sqrt(3)

    scored = F.transform(coded, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"),
                                                   x["n"].cast("bigint").alias("length"), z(x).alias("z")))
    tenths = lambda x: 10 / math.log(10) * (x["z"] * x["z"] / 2 + math.log(2))
    return F.transform(scored, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["length"].alias("length"),
        F.when(x["z"] < 0, F.least(F.floor(tenths(x)).cast("int"), F.lit(MAX_BIN))).otherwise(0).alias("bin")))


def length_class(length: Column) -> Column:
    out = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        out = F.when(length >= low, low).otherwise(out)
    return out


def thresholds(judged: DataFrame) -> dict[int, int]:
    """Length class -> least evidence of a find: Benjamini and Hochberg's step-up within each class,
    over all candidates of all documents. One row per class and bin meets here, a bounded table."""
    counts = (judged.select(F.explode("candidates").alias("x"))
              .groupBy(length_class(F.col("x.length")).alias("class"), F.col("x.bin").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    strongest = Window.partitionBy("class").orderBy(F.desc("bin"))
    passed = (counts.withColumn("found", F.sum("n").over(strongest))
              .withColumn("all", F.sum("n").over(Window.partitionBy("class")))
              .where((F.col("bin") > 0) & (F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("all")
                                           <= FALSE_DISCOVERIES * F.col("found"))))
    return {r["class"]: r["bin"] for r in passed.groupBy("class").agg(F.min("bin").alias("bin")).collect()}


def scan_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind (assign,
    access, hex, random), joined by commas; ``base_sha256`` is the digest of those of the three
    patterns. Matches of a pattern are leftmost and do not overlap; the patterns are looked for
    independently. A random span is a word of 16 or more characters of ``[A-Za-z0-9+/_-]``
    that passes the battery, with its evidence controlled for false discoveries within its
    length class over all documents (a word's evidence grows with its length, and short words, which
    are many, must bring more). Right matches of assign, then access, then hex are blanked
    first, each in what the one before left, so that no find is told twice.

    A null text counts as empty and has no spans; repeated rows get equal answers (each counts
    in the control), and an empty table gives no rows. Other columns are ignored, whatever their names.
    Nothing is shuffled but the counts of the control.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    for kind, pattern in PATTERNS:
        rows = with_matches(rows, "text", pattern, kind, value=kind == "assign")

    def spans(number, kind):
        right = F.filter(kind, lambda x: right_match(kind, x))
        return F.transform(right, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), x["end"].alias("end")))

    rows = rows.withColumn("base", F.array_sort(F.concat(*[spans(i, kind) for i, (kind, _) in enumerate(PATTERNS)])))
    none = F.size("base") == 0
    rows = rows.select("doc_id", F.when(none, F.col("text")).otherwise(blanked("assign", "assign")).alias("text"), "base")
    for kind, pattern in PATTERNS[1:]:
        # a text without base spans has nothing to blank and is not searched again
        rows = with_matches(rows.withColumn("__t", F.when(F.size("base") > 0, F.col("text")).otherwise("")),
                            "__t", pattern, kind)
        rows = (rows.withColumn("text", F.when(F.size("base") > 0, blanked(kind, kind)).otherwise(F.col("text")))
                .select("doc_id", "text", "base"))
    rows = with_matches(rows, "text", TOKEN, "token")
    judged = written(rows.select("doc_id", "base", battery(F.col("token")).alias("candidates")), "secrets")
    least = thresholds(judged)
    bar = F.create_map(*[F.lit(v) for low in LENGTHS for v in (low, least.get(low, MAX_BIN + 1))])
    random = F.transform(F.filter("candidates", lambda x: x["bin"] >= bar[length_class(x["length"])]), lambda x: F.struct(
        x["start"].alias("start"), F.lit(len(PATTERNS)).alias("kind"), x["end"].alias("end")))
    names = F.array(*[F.lit(k) for k, _ in PATTERNS], F.lit("random"))

    def joined(found):
        return F.array_join(F.transform(found, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def number(i):
        return F.size(F.filter("base", lambda x: x["kind"] == i)).cast("bigint")

    return (judged.withColumn("random", random)
            .select("doc_id", *[number(i).alias(f"n_{kind}") for i, (kind, _) in enumerate(PATTERNS)],
                    F.size("random").cast("bigint").alias("n_random"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                    joined(F.array_sort(F.concat("base", "random"))).alias("spans")))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
