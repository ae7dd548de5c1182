"""Written and read back: CSV, split folders, JSON payloads, sorted parquet."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.operators import corpus as C
from tidewatch.operators import evaluate as E
from tidewatch.operators import similarity as S
from tidewatch.plans.evaluation import score_sql
from tidewatch.plans.registry import query, table
from tidewatch.plans.telemetry import MARK_SQL, marked_events
from tidewatch.plans.text import SPLIT_SQL, STRIP_SQL, split_documents
from tidewatch.session import new_table_path
from tidewatch.sources import readers, writers


@query(
    "csv_roundtrip",
    f"SELECT source, category, is_attack::INT AS is_attack, md5(text) AS text_md5 FROM (SELECT {STRIP_SQL} AS text, source, lang AS category, lang <> 'en' AS is_attack FROM documents) WHERE text <> ''",
)
def csv_roundtrip(spark, sf):
    docs = table(spark, sf, "documents")
    corpus = docs.select(
        X.strip(F.col("text")).alias("text"), (F.col("lang") != "en").alias("is_attack"), "source", F.col("lang").alias("category")
    )
    path = new_table_path(spark, "corpus")
    # an empty text is written as an absent one and dropped on the way back
    writers.write_csv(corpus.withColumn("text", F.nullif("text", F.lit(""))), path)
    back = readers.read_csv(spark, path)
    return back.select("source", "category", F.col("is_attack").cast("int").alias("is_attack"), F.md5("text").alias("text_md5"))


@query("split_outputs", f"WITH {SPLIT_SQL} SELECT split, lang, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM split GROUP BY split, lang")
def split_outputs(spark, sf):
    path = new_table_path(spark, "splits")
    writers.write_splits(split_documents(spark, sf).select("doc_id", "lang", "split"), path)
    back = spark.read.csv(path, schema="doc_id long, lang string, split string", header=True)
    return back.groupBy("split", "lang").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))


@query(
    "json_report",
    f"""WITH c AS (
  SELECT lang, count(*) FILTER (WHERE n_chars >= 2000 AND quality = 1) AS tp, count(*) FILTER (WHERE n_chars >= 2000 AND quality <> 1) AS fp,
         count(*) FILTER (WHERE n_chars < 2000 AND quality = 1) AS fn, count(*) FILTER (WHERE n_chars < 2000 AND quality <> 1) AS tn
  FROM documents JOIN labels USING (doc_id) GROUP BY lang)
SELECT *, {score_sql()} FROM c""",
)
def json_report(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    report = E.binary_metrics(rows, "quality", F.col("n_chars") >= 2000, by=["lang"])
    path = new_table_path(spark, "report")
    writers.write_json(report, path)
    return spark.read.schema(report.schema).json(path)


@query(
    "sorted_output",
    f"WITH {MARK_SQL} SELECT event_type, count(*) AS n, count(DISTINCT incident_no) AS incidents FROM marked GROUP BY event_type",
)
def sorted_output(spark, sf):
    """Marked anomalies stored in (key, time) order."""
    path = new_table_path(spark, "sorted")
    writers.write_sorted(marked_events(spark, sf), path, ["event_type"], ["ts", "event_id"])
    return readers.read_table(spark, path).groupBy("event_type").agg(
        F.count("*").alias("n"), F.countDistinct("incident_no").alias("incidents")
    )


@query(
    "corpus_order",
    "SELECT doc_id, lang FROM documents ORDER BY doc_id",
)
def corpus_order(spark, sf):
    """Splits put together again and brought back into corpus order."""
    rows = split_documents(spark, sf)
    parts = [rows.filter(F.col("split") == s) for s in ("train", "val", "test")]
    return C.union_all(parts).select("doc_id", "lang").orderBy("doc_id")


@query(
    "markdown_sections",
    """WITH counted AS (SELECT n_name, c_mktsegment, count(*) AS n, row_number() OVER (PARTITION BY n_name ORDER BY c_mktsegment) AS section_no
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_mktsegment)
SELECT n_name, section_no, c_mktsegment AS title, n || ' customers' AS text FROM counted
UNION ALL SELECT DISTINCT n_name, 0, '# ' || n_name, '' FROM counted""",
)
def markdown_sections(spark, sf):
    """A markdown file per nation, with a section per market segment, written and read back as sections."""
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    counted = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n")).join(nations, "c_nationkey")
    # a nation has a handful of segments
    parts = counted.groupBy("n_name").agg(F.array_sort(F.collect_list(F.format_string("## %s\n%d customers", "c_mktsegment", "n"))).alias("parts"))
    path = new_table_path(spark, "markdown")
    files = parts.select("n_name", F.concat(F.lit("# "), "n_name", F.lit("\n"), F.array_join("parts", "\n")).alias("content"))
    files.write.partitionBy("n_name").text(path)
    read = readers.read_markdown(spark, f"{path}/*").select(F.regexp_extract("content", "^# (.*)", 1).alias("n_name"), "content")
    cut = S.sections(read, "n_name", "content")
    return cut.select("n_name", F.col("section_no").cast("long").alias("section_no"), X.strip(F.col("title")).alias("title"), X.strip(F.col("text")).alias("text"))
