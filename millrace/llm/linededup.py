"""Lines that many documents repeat: exploded, hashed, counted by document, dropped and put together again by position."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.operators.lookup import small_enough
from millrace.session import written

#: Fixed value: the white space that a line's key is stripped of.
SPACE = " \t\n\x0b\x0c\r"


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_key(line: Column) -> Column:
    return F.translate(stripped(line), ascii_uppercase, ascii_lowercase)


def _lines(row: str) -> Column:
    return F.split(F.coalesce(F.col(f"{row}.text"), F.lit("")), "\n")


def repeated_keys(places: DataFrame, min_docs: int) -> DataFrame:
    """``hash`` and ``keeper``, the largest doc_id, of each key found in ``min_docs`` documents or more.

    Rows are counted once for each document before they are shuffled, so neither a line that all documents hold nor one that
    a document repeats gathers in one task.
    """
    held = places.groupBy("hash", "doc_id").agg(F.lit(1).alias("_one"))
    counted = held.groupBy("hash").agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
    return counted.where(F.col("docs") >= min_docs).select("hash", "keeper")


def without_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, name: str = "lines") -> DataFrame:
    """All rows and columns and the struct ``name``: ``n_lines``, ``n_dropped`` and the ``text`` of the lines that stay.

    Whole texts are split at ``\\n``. A key, the line without white space at its ends and with A-Z in lower case, of at
    least ``min_chars`` characters that at least ``min_docs`` documents hold loses all its lines but those in the largest
    doc_id holding it; the other lines keep their places. Keys are told apart by 128 bits of hash.

    Null and empty texts are one empty line. A row is told by its doc_id and its text: repeated rows of one doc_id are one
    document, each of them is returned and loses the same lines. Rows without a doc_id count towards no document, keep
    nothing against others, and lose what is dropped. Lines and texts may be of any length; an empty table gives no rows. A
    column already called ``name`` is replaced, any other column is left as it is.

    Only hashes and places are shuffled by key. Texts are shuffled once, to meet the places of their dropped lines.
    """
    rows = docs.drop(name).select(F.struct("*").alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("doc_id"), F.md5(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_id"))
    lines = rows.select("doc_id", "text_id", F.posexplode(_lines("row")).alias("place", "line"))
    long_enough = lines.where(F.char_length(stripped(F.col("line"))) >= min_chars)
    places = long_enough.select("doc_id", "text_id", "place", F.unhex(F.md5(line_key(F.col("line")).cast("binary"))).alias("hash"))
    repeated = written(repeated_keys(places, min_docs), "repeated_keys")
    repeated = F.broadcast(repeated) if small_enough(repeated.select(F.hex("hash").alias("hash"), "keeper")) else repeated
    gone = places.join(repeated, "hash").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    gone = gone.groupBy("doc_id", "text_id").agg(F.collect_set("place").alias("gone"))
    # A null id has a place of its own in the join: ids are long, so no text of one is empty.
    by = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_id"))
    gone = written(gone.select(by.alias("by"), "gone"), "dropped_lines")
    n_dropped = F.coalesce(F.size("gone"), F.lit(0))
    found = rows.select("row", by.alias("by")).join(gone, "by", "left").select("row", "gone", n_dropped.alias("n_dropped"), _lines("row").alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    rest = F.array_join(F.transform(kept, lambda place: F.get("lines", place)), "\n")
    text = F.when(F.col("n_dropped") == 0, F.coalesce(F.col("row.text"), F.lit(""))).otherwise(rest)
    out = F.struct(F.size("lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"), text.alias("text"))
    return found.select("row.*", out.alias(name))


def op12_lines(spark, sf_dir):
    kept = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.col("lines.text").cast("binary"), 256).alias("kept_sha256"))


#: The same in SQL.
SQL = """with split as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
lines as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from split),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
marked as (
  select k.*, r.key is not null and k.doc_id <> r.keeper as gone from keyed k left join repeated r using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id"""
