"""Exact nearest-vector search, section indexes and grounding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions import fixed_values as V
from tidewatch.functions.vectors import as_matrix, nearest_rows
from tidewatch.operators import decisions as D
from tidewatch.operators import metric_index

BLOCK_BYTES = 64 * 1024 * 1024
BATCH_ROWS = 2048
BROADCAST_ROWS = 100_000


def nearest(
    queries: DataFrame,
    known: DataFrame,
    query_id: str,
    known_id: str,
    query_vector: str = "embedding",
    known_vector: str = "embedding",
    k: int = 1,
    metric: str = "cosine",
    skip_same: bool = False,
    block_bytes: int = BLOCK_BYTES,
    query_rows: int | None = None,
) -> DataFrame:
    """``(query_id, known_id, distance, rank)`` of the ``k`` nearest known vectors, exactly.

    A known set whose counted size stays under ``block_bytes`` is broadcast. A larger one is cut into balls
    (``metric_index``) of about that size; a query meets only the balls that its bounds do not exclude, in groups of at
    most a ball's part and ``query_rows`` queries, which return their ``k`` best. Query ids are distinct.
    """
    q = queries.select(F.col(query_id).alias("_q"), F.col(query_vector).alias("_qv")).filter("_qv IS NOT NULL")
    i = known.select(F.col(known_id).alias("_i"), F.col(known_vector).alias("_iv")).filter("_iv IS NOT NULL")
    size = i.agg(F.count("*").alias("n"), F.max(F.size("_iv")).alias("dim")).first()
    types = {"q": dict(q.dtypes)["_q"], "id": dict(i.dtypes)["_i"]}
    schema = f"q {types['q']}, id {types['id']}, distance double, rank int"
    if not size.n:
        found = queries.sparkSession.createDataFrame([], schema)
    elif size.n * size.dim * 8 <= block_bytes:
        found = _against_broadcast(q, i, k, metric, skip_same, schema)
    else:
        block_rows = max(1, block_bytes // (size.dim * 8))
        held, balls = metric_index.indexed(i, metric, size.n, block_rows)
        _, each = metric_index.visits(q, balls, held, k, metric, skip_same, schema, block_rows, query_rows or block_rows)
        best = Window.partitionBy("q").orderBy(F.round("distance", 9), "id")
        found = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    name = query_id if query_id != known_id else f"query_{query_id}"
    return found.select(F.col("q").alias(name), F.col("id").alias(known_id), "distance", "rank")


def _against_broadcast(q, i, k, metric, skip_same, schema):
    known = i.toPandas().sort_values("_i", ignore_index=True)
    held = q.sparkSession.sparkContext.broadcast((known["_i"].to_numpy(), as_matrix(known["_iv"])))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = held.value
        for batch in batches:
            for at in range(0, len(batch), BATCH_ROWS):
                part = batch.iloc[at : at + BATCH_ROWS]
                yield nearest_rows(part["_q"].to_numpy(), as_matrix(part["_qv"]), ids, matrix, k, metric, skip_same)

    return q.mapInPandas(search, schema)


def near_duplicates(
    queries: DataFrame,
    known: DataFrame,
    query_id: str,
    known_id: str,
    category: str = "category",
    threshold: float = V.NEAR_DUPLICATE_DISTANCE,
    **options,
) -> DataFrame:
    """Every query with its nearest known attack's category and distance, and whether it is a near
    duplicate. Without known attacks there is no signal: nulls and False."""
    best = nearest(queries, known, query_id, known_id, **options)
    name = query_id if query_id != known_id else f"query_{query_id}"
    kinds = known.select(F.col(known_id), F.col(category).alias("nearest_category"))
    # one known attack may be the nearest of a third of the queries
    if known.count() <= BROADCAST_ROWS:
        kinds = F.broadcast(kinds)
    hit = best.join(kinds, known_id).select(F.col(name).alias("_hit"), "nearest_category", "distance")
    joined = queries.join(hit, queries[query_id] == F.col("_hit"), "left").drop("_hit")
    return joined.withColumns(
        {
            "is_near_duplicate": F.coalesce(F.col("distance") <= threshold, F.lit(False)),
            "similarity_distance": F.round("distance", 4),
        }
    ).drop("distance")


# --- grounding -----------------------------------------------------------------------------------


def retrieve(hits: DataFrame, query_id: str, file: str = "file_name", body: str = "text") -> DataFrame:
    """Per query: top score, sources with their scores in rank order, and the context block.

    ``hits`` holds at most a few ranked rows per query with ``score``, the file and its text."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "score", F.col(file).alias("file"), F.col(body).alias("text"))))
    grouped = hits.groupBy(query_id).agg(ordered.alias("_h"))
    block = lambda h: F.concat(F.lit("[Source: "), h["file"].cast("string"), F.lit("]\n"), h["text"])
    return grouped.select(
        query_id,
        F.get("_h", F.lit(0))["score"].alias("top_score"),
        F.transform("_h", lambda h: F.struct(h["file"].alias("file"), F.round(h["score"], 4).alias("score"))).alias("sources"),
        F.array_join(F.transform("_h", block), "\n\n---\n\n").alias("context"),
    )


def grounding_gate(queries: DataFrame, retrieved: DataFrame, query_id: str, threshold: float = V.GROUNDING_THRESHOLD) -> DataFrame:
    """Low confidence, no sources and an escalation text under the threshold or without hits."""
    joined = queries.join(retrieved, query_id, "left")
    label = D.grounding_label(F.col("top_score"), threshold)
    low = label == "low"
    none = F.array().cast(joined.schema["sources"].dataType)
    return joined.select(
        *queries.columns,
        label.alias("grounding_confidence"),
        F.round(F.coalesce("top_score", F.lit(0.0)), 4).alias("top_similarity_score"),
        F.when(low, none).otherwise(F.col("sources")).alias("retrieved_sources"),
        F.when(low, F.lit(V.NO_MATCH_TEXT)).otherwise(F.col("context")).alias("result"),
    )


# --- sections, text vectors, index ---------------------------------------------------------------


def sections(documents: DataFrame, key: str, content: str, heading: str = r"(?m)^## ", title_end: str = "\n") -> DataFrame:
    """``(key, section_no, title, text, requires_approval)``: the content cut at its headings. Piece
    0 is what stands before the first heading."""
    cut = documents.select(key, F.posexplode(F.split(content, heading)).alias("section_no", "_piece"))
    title = F.trim(F.substring_index("_piece", title_end, 1))
    return cut.select(
        key,
        "section_no",
        title.alias("title"),
        F.trim(F.expr(f"substring(_piece, {len(title_end)} + length(substring_index(_piece, '{_sql(title_end)}', 1)) + 1)")).alias("text"),
        ((F.col("section_no") > 0) & (title == V.APPROVAL_SECTION)).alias("requires_approval"),
    )


def _sql(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")


def text_vectors(features: int = 1024, text: str = "text", output: str = "embedding") -> Pipeline:
    """Hashed terms weighted by rarity, unit length. A stand-in for a sentence encoder: an Arrow UDF
    that returns an array of floats can take its place."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit"),
        ]
    )


def embed(model: PipelineModel, df: DataFrame, output: str = "embedding") -> DataFrame:
    done = model.transform(df)
    return done.withColumn(output, vector_to_array("_unit", "float32")).drop("_words", "_tf", "_weighted", "_unit")


def content_hash(*columns: str) -> Column:
    return F.sha2(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in columns]), 256)


def refresh_index(stored: DataFrame, fresh: DataFrame, digest: str = "content_hash") -> DataFrame:
    """Rows of ``fresh`` that the index does not hold yet, one per content. Only these need vectors."""
    first = Window.partitionBy(digest).orderBy(*[c for c in fresh.columns if c != digest and _sortable(fresh, c)])
    distinct = fresh.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")
    return distinct.join(stored.select(digest), digest, "left_anti")


def _sortable(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StringType, T.NumericType, T.BooleanType, T.TimestampType))


def hit_rate(hits: DataFrame, truth: DataFrame, query_id: str, known_id: str, expected: str, ks: Sequence[int] = (1, 3)) -> DataFrame:
    """Share of the labelled queries whose expected row is among the first ``k``."""
    found = hits.join(truth.select(query_id, expected), query_id).filter(F.col(known_id) == F.col(expected))
    ranks = truth.select(query_id).join(found.groupBy(query_id).agg(F.min("rank").alias("_r")), query_id, "left")
    return ranks.agg(
        F.count("*").alias("queries"),
        *[F.avg(F.coalesce(F.col("_r") <= k, F.lit(False)).cast("double")).alias(f"hit_rate_{k}") for k in ks],
    )
