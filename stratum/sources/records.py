"""Records of quoted CSV text, found by all tasks of a splittable scan.

A quoted field may hold line breaks, so where a record begins depends on all the text before
it. Every line is a map of two states, "outside" and "inside a quoted field", to the state at
its end; maps of neighbouring lines compose, so the state in front of any line is a prefix scan:

1. lines are read splittably and cut into chunks of a split; an aggregate, combined before its
   shuffle and without the text, composes the maps of each chunk;
2. over the chunks of a file, a row each, a scan tells in which state each chunk begins;
3. a chunk that begins outside has one record per line up to the first line that leaves a
   quoted field open; those lines are not shuffled. The few facts of chunks that hold other
   lines (and of each file's first) are broadcast, a row per chunk;
4. in the rest of its chunk every line gets the state before it by a window, all chunks at once;
5. a line that begins and ends outside is a record as it is; the lines of longer records
   meet under the number of the line they begin with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: lines of a split that are scanned together
CHUNK_LINES = 1 << 15

# modes within a line: at the start of a field, within an unquoted one, within a quoted one, and
# right after a quote in a quoted one (its end, or the first of a doubled quote)
FIELD_START, UNQUOTED, QUOTED, AFTER_QUOTE = range(4)


#: a field without stray quotes, and the inside of a quoted one; possessive, so nothing is tried twice
INSIDE = r'[^"]*+(?:""[^"]*+)*+'
FIELD = rf'(?:"{INSIDE}"|[^",]*+)'
#: lines up to this length are first held against patterns of well-formed lines
PATTERN_CHARS = 4000


def ends_quoted(line: Column, begins_quoted: bool) -> Column:
    """Whether a quoted field is open at the end of the line; a quote inside an unquoted field is text.

    Well-formed lines are settled by a pattern; the others, and very long ones, quote by quote.
    """
    pieces = F.split(line, '"', -1)

    def text(mode, piece):
        return (F.when((piece == "") | (mode == QUOTED), mode)
                .when(piece.endswith(","), FIELD_START).otherwise(UNQUOTED))

    def quote(mode):
        return (F.when(mode == FIELD_START, QUOTED).when(mode == UNQUOTED, UNQUOTED)
                .when(mode == QUOTED, AFTER_QUOTE).otherwise(QUOTED))

    begin = F.lit(QUOTED) if begins_quoted else text(F.lit(FIELD_START), F.element_at(pieces, 1))
    end = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces) - 1), begin, lambda mode, piece: text(quote(mode), piece))
    well_formed = rf'^{INSIDE}"(?:,{FIELD})*+$' if begins_quoted else rf"^{FIELD}(?:,{FIELD})*+$"
    return (F.when(~line.contains('"'), F.lit(begins_quoted))
            .when((F.length(line) <= PATTERN_CHARS) & line.rlike(well_formed), F.lit(False))
            .otherwise(end == QUOTED))


def _state(begins: Column, settled: Column, swaps: Column) -> Column:
    """The state after some lines: ``settled`` (state, swaps until then) is the last line whose two
    ends agree, if any; lines that swap the state count modulo 2."""
    return F.coalesce(settled["state"], begins) != ((swaps - F.coalesce(settled["swaps"], F.lit(0))) % 2 == 1)


CHUNK = ["file", "block", "chunk"]


def csv_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8",
              header: bool = True) -> DataFrame:
    """The lines of all records: CHUNK, line, value, alone (the line is a record by itself) and
    record_no (the line that a longer record begins with; null if that lies in an earlier chunk).

    The first record of each file is left out with ``header``, empty lines outside of quotes
    always. Any encoding whose line ends are those of ASCII can be read.
    """
    source = spark.read.text(paths if isinstance(paths, str) else list(paths))
    value = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    text = source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("line"), value.alias("value"))
    chunk = F.shiftright(F.col("line").bitwiseAND((1 << 33) - 1), CHUNK_LINES.bit_length() - 1)
    text = text.select(*CHUNK[:2], chunk.alias("chunk"), "line", "value")
    from_out, from_in = ends_quoted(F.col("value"), False), ends_quoted(F.col("value"), True)
    lines = text.select(*CHUNK, "line", "value", from_out.alias("from_out"), from_in.alias("from_in"))
    settles = F.col("from_out") == F.col("from_in")
    swaps = F.col("from_out") & ~F.col("from_in")

    # 1. chunks: the last settling line, the swaps after it (at most CHUNK_LINES numbers), the first text
    chunks = (lines.groupBy(*CHUNK).agg(
        F.max(F.when(settles, F.struct("line", "from_out"))).alias("last"),
        F.collect_list(F.when(swaps, F.col("line"))).alias("swap_lines"),
        F.min(F.when(F.col("from_out"), F.col("line"))).alias("opens"),
        F.min(F.when(F.col("value") != "", F.col("line"))).alias("text_line"))
        .select(*CHUNK, "text_line", "opens", F.col("last.from_out").alias("state"),
                F.size(F.filter("swap_lines", lambda x: x > F.coalesce("last.line", F.lit(-1)))).alias("later")))

    # 2. how each chunk begins
    before = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole_file = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    chunks = chunks.withColumn("upto", F.coalesce(F.sum("later").over(before), F.lit(0)) + F.col("later"))
    # swaps are counted through; those up to a settling chunk's settling line are taken off
    settled = F.last(F.when(F.col("state").isNotNull(), F.struct("state", (F.col("upto") - F.col("later")).alias("swaps"))),
                     ignorenulls=True).over(before)
    chunks = (chunks.select(*CHUNK, "text_line", "opens",
                            _state(F.lit(False), settled, F.col("upto") - F.col("later")).alias("begins"),
                            F.first("text_line", ignorenulls=True).over(whole_file).alias("head"))
              .withColumn("odd_from", F.when(F.col("begins"), -1).otherwise(F.col("opens"))))

    # 3. until a chunk's first line that opens a quoted field and leaves it open, lines are records
    # and go on as they come; a chunk without a row here holds no other line
    noted = chunks.where(F.col("odd_from").isNotNull() | (F.col("head") == F.col("text_line")))
    plain = (text.join(F.broadcast(noted.select(*CHUNK, "odd_from", "head")), CHUNK, "left")
             .where((F.col("value") != "") & F.coalesce(F.col("line") < F.col("odd_from"), F.lit(True))))
    if header:
        plain = plain.where(~F.col("line").eqNullSafe(F.col("head")))
    plain = plain.select(*CHUNK, "line", "value", F.lit(True).alias("alone"), F.col("line").alias("record_no"))

    # 4. the state before every line from there on
    rows = Window.partitionBy(*CHUNK).orderBy("line")
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.broadcast(chunks.where(F.col("odd_from").isNotNull()).select(*CHUNK, "odd_from", "begins", "head"))
    known = (text.join(odd, CHUNK).where(F.col("line") >= F.col("odd_from"))
             .withColumns({"from_out": from_out, "from_in": from_in}))
    known = known.withColumn("swaps", F.coalesce(F.sum(swaps.cast("int")).over(earlier), F.lit(0)))
    settled = F.last(F.when(settles, F.struct(F.col("from_out").alias("state"), "swaps")), ignorenulls=True).over(earlier)
    known = known.withColumn("before", _state(F.col("begins"), settled, F.col("swaps")))
    known = known.withColumn("record_no", F.last(F.when(~F.col("before"), F.col("line")), ignorenulls=True).over(
        rows.rowsBetween(Window.unboundedPreceding, 0)))
    after = F.when(F.col("before"), F.col("from_in")).otherwise(F.col("from_out"))
    known = known.withColumn("alone", ~F.col("before") & ~after)
    if header:
        known = known.withColumn("is_head", F.col("record_no").eqNullSafe(F.col("head"))).where(
            "not (alone and is_head)").withColumn("record_no", F.when(F.col("is_head"), -1).otherwise(F.col("record_no")))
    known = known.where(~F.col("alone") | (F.col("value") != "")).select(*CHUNK, "line", "value", "alone", "record_no")
    return plain.unionByName(known)


def long_records(lines: DataFrame) -> DataFrame:
    """(record): the records of several lines among ``csv_lines``, joined by newlines.

    A chunk that begins inside a record takes its number from the chunks before it: a scan over
    one row per chunk that holds such lines. A record is one value and has to fit a task.
    """
    lines = lines.where("not alone")
    before = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (lines.groupBy(*CHUNK).agg(F.max_by("record_no", "line").alias("last"))
               .select(*CHUNK, F.last("last", ignorenulls=True).over(before).alias("carried")))
    return (lines.join(carried, CHUNK).withColumn("no", F.coalesce("record_no", "carried")).where("no >= 0")
            .groupBy("file", "no").agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"))
            .select(F.array_join(F.col("parts.value"), "\n").alias("record")))


def csv_records(spark: SparkSession, paths: str | Sequence[str], parse, path: str, encoding: str = "UTF-8",
                header: bool = True) -> DataFrame:
    """Every record of the files through ``parse`` (a Column of text -> a struct), written to ``path``.

    The lines pass the scan once: those that are records by themselves are parsed and written
    right there, the others beside them, to be joined, parsed and added.
    """
    lines = csv_lines(spark, paths, encoding, header)
    alone = F.col("alone")
    # "several" is a plain column: writing by it as a partition would sort every task's records
    (lines.select(F.when(alone, parse(F.col("value"))).alias("record"), (~alone).cast("int").alias("several"),
                  *[F.when(~alone, F.col(c)).alias(c) for c in ("file", "block", "chunk", "line", "value", "record_no")])
     .write.mode("overwrite").parquet(path))
    schema = StructType([f for f in lines.select(parse(F.col("value")).alias("record"), *CHUNK, "line", "value",
                                                 "record_no").schema] + [StructField("several", IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    long = long_records(stored.where("several = 1").withColumn("alone", F.lit(False)))
    (long.select(parse(F.col("record")).alias("record"), F.lit(2).alias("several"))
     .write.mode("append").parquet(path))
    return spark.read.schema(schema).parquet(path).where("several != 1").select("record.*")
