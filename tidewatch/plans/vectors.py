"""Nearest vectors, grounding, section indexes and model jobs over the vector and text tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidewatch.operators import corpus as C
from tidewatch.operators import decisions as D
from tidewatch.operators import evaluate as E
from tidewatch.operators import metrics as M
from tidewatch.operators import models as Mo
from tidewatch.operators import similarity as S
from tidewatch.plans.evaluation import four
from tidewatch.plans.registry import bound, query, table
from tidewatch.plans.telemetry import EXTRA, ORDER, ROLLED, metric_events, truth_windows
from tidewatch.session import stored
from tidewatch.sources import readers

# Every vector is a query against all the others.
RANKED_SQL = """
pair AS (
  SELECT q.vec_id AS query_vec_id, i.vec_id, i.label,
         1 - list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]) AS distance
  FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_vec_id ORDER BY round(distance, 9), vec_id) AS rank FROM pair)"""


def vectors(spark, sf):
    return readers.read_vectors(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding")


def neighbours(spark, sf, k, **options):
    rows = vectors(spark, sf)
    return S.nearest(rows, rows, "vec_id", "vec_id", k=k, skip_same=True, **options)


@query(
    "nearest_known",
    f"""WITH {RANKED_SQL}
SELECT query_vec_id AS vec_id, label AS nearest_category, (distance <= 0.35)::INT AS is_near_duplicate,
       {four('distance')} AS similarity_distance
FROM ranked WHERE rank = 1""",
)
def nearest_known(spark, sf):
    known = table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").alias("category"))
    done = S.near_duplicates(vectors(spark, sf), known, "vec_id", "vec_id", skip_same=True)
    return done.select("vec_id", "nearest_category", F.col("is_near_duplicate").cast("int").alias("is_near_duplicate"), "similarity_distance")


@query(
    "topk_sections",
    f"WITH {RANKED_SQL} SELECT query_vec_id, vec_id, rank, round(1 - distance, 6) AS score FROM ranked WHERE rank <= 3",
)
def topk_sections(spark, sf):
    return neighbours(spark, sf, 3).select("query_vec_id", "vec_id", "rank", F.round(1 - F.col("distance"), 6).alias("score"))


@query(
    "topk_in_balls",
    f"WITH {RANKED_SQL} SELECT query_vec_id, vec_id, rank, round(distance, 6) AS distance FROM ranked WHERE rank <= 2",
)
def topk_in_balls(spark, sf):
    """Through the ball partition, with balls of about 250 vectors."""
    found = neighbours(spark, sf, 2, block_bytes=1 << 17)
    return found.select("query_vec_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


GATE_SQL = f"""{RANKED_SQL},
hit AS (SELECT query_vec_id, rank, 1 - distance AS score, 'label-' || label AS file, 'vector ' || vec_id AS text FROM ranked WHERE rank <= 3),
top AS (
  SELECT query_vec_id AS vec_id, max(score) AS top_score,
         string_agg('[Source: ' || file || ']' || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
  FROM hit GROUP BY query_vec_id),
gate AS (
  SELECT vec_id, CASE WHEN coalesce(top_score, 0) < 0.4 THEN 'low' ELSE 'high' END AS grounding_confidence, {four('top_score')} AS top_similarity_score,
         CASE WHEN coalesce(top_score, 0) < 0.4 THEN 0 ELSE 3 END AS n_sources,
         CASE WHEN coalesce(top_score, 0) < 0.4 THEN 'NO CONFIDENT RUNBOOK MATCH - escalate to human SRE. Do not auto-generate remediation for this anomaly pattern.' ELSE context END AS result
  FROM top)"""


def gated(spark, sf):
    files = table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.lit("label-"), "label").alias("file_name"), F.concat(F.lit("vector "), "vec_id").alias("text")
    )
    # one section may be the nearest of a third of the queries
    if files.count() <= S.BROADCAST_ROWS:
        files = F.broadcast(files)
    hits = neighbours(spark, sf, 3).withColumn("score", 1 - F.col("distance")).join(files, "vec_id")
    found = S.retrieve(hits, "query_vec_id").withColumnRenamed("query_vec_id", "vec_id")
    return S.grounding_gate(vectors(spark, sf).select("vec_id"), found, "vec_id")


@query("grounding_gate", f"WITH {GATE_SQL} SELECT vec_id, grounding_confidence, top_similarity_score, n_sources, result FROM gate")
def grounding_gate(spark, sf):
    return gated(spark, sf).select(
        "vec_id", "grounding_confidence", "top_similarity_score", F.size("retrieved_sources").alias("n_sources"), "result"
    )


@query(
    "grounding_report",
    f"""WITH {GATE_SQL} SELECT count(*) AS total_calls, count(*) FILTER (WHERE grounding_confidence = 'high') AS grounded,
       count(*) FILTER (WHERE grounding_confidence = 'low') AS escalated_low_confidence FROM gate""",
)
def grounding_report(spark, sf):
    return D.grounding_counts(gated(spark, sf))


@query(
    "grounding_labels",
    f"WITH {GATE_SQL} SELECT grounding_confidence, count(*) AS n, round(count(*) / (SELECT count(*) FROM gate), 6) AS share FROM gate GROUP BY 1",
)
def grounding_labels(spark, sf):
    # the total and the groups both read it
    return C.category_shares(stored(gated(spark, sf).select("grounding_confidence"), "gated"), "grounding_confidence")


@query(
    "aligned_matrix",
    """SELECT d.doc_id, len(e.embedding) + 2 AS width, e.embedding[1]::DOUBLE AS first_entry, d.n_chars::DOUBLE AS last_but_one, length(d.lang)::DOUBLE AS last_entry
FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id""",
)
def aligned_matrix(spark, sf):
    docs = table(spark, sf, "documents")
    features = docs.select("doc_id", "n_chars", F.length("lang").alias("lang_length"))
    rows = Mo.aligned(docs.select("doc_id", "lang"), features, vectors(spark, sf).withColumnRenamed("vec_id", "doc_id"), "doc_id")
    x = Mo.joined_vector("embedding", ["n_chars", "lang_length"])
    return rows.select(
        "doc_id", F.size(x).alias("width"), F.get(x, F.lit(0)).alias("first_entry"),
        F.element_at(x, -2).alias("last_but_one"), F.element_at(x, -1).alias("last_entry"),
    )


CLASSES = ["benign", "direct_injection", "instruction_override", "obfuscation", "roleplay"]
# a customer's orders by priority stand in for a classifier's output: five shares that add up to one
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SHARES_SQL = f"""shares AS (
  SELECT o_custkey, [{', '.join(f"count(*) FILTER (o_orderpriority = '{p}') / count(*)" for p in PRIORITIES)}] AS p
  FROM orders GROUP BY o_custkey)"""
LABEL_SQL = f"{CLASSES}[list_position(p, list_max(p))]"


def class_shares(spark, sf):
    shares = [F.count_if(F.col("o_orderpriority") == p) / F.count("*") for p in PRIORITIES]
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.array(*shares).alias("p"))


@query(
    "argmax_label",
    f"""WITH {SHARES_SQL} SELECT o_custkey, {LABEL_SQL} AS label, list_max(p) AS confidence, 1.0::DOUBLE - p[1] AS attack_confidence FROM shares""",
)
def argmax_label(spark, sf):
    label, top = D.argmax_label(F.col("p"), CLASSES)
    return class_shares(spark, sf).select(
        "o_custkey", label.alias("label"), top.alias("confidence"), D.attack_confidence(F.col("p"), CLASSES).alias("attack_confidence")
    )


@query(
    "prompt_decisions",
    f"""WITH {RANKED_SQL}, {SHARES_SQL},
near AS (SELECT query_vec_id AS vec_id, label AS nearest_category, distance <= 0.35 AS near FROM ranked WHERE rank = 1),
tiered AS (
  SELECT n.*, s.p, CASE WHEN 1.0::DOUBLE - p[1] >= 0.8::DOUBLE THEN 'high' WHEN 1.0::DOUBLE - p[1] >= 0.5::DOUBLE THEN 'medium' ELSE 'low' END AS risk_tier
  FROM near n JOIN shares s ON n.vec_id = s.o_custkey)
SELECT vec_id, {LABEL_SQL} AS label, list_max(p) AS confidence, risk_tier, nearest_category, near::INT AS is_near_duplicate,
       CASE WHEN near AND risk_tier = 'low' THEN 'medium' ELSE risk_tier END AS final_tier, (near AND risk_tier = 'low')::INT AS risk_tier_upgraded,
       (near OR risk_tier <> 'low')::INT AS quarantine_triggered FROM tiered""",
)
def prompt_decisions(spark, sf):
    """Class probabilities, tier, nearest known text, upgrade and quarantine in one job."""
    known = table(spark, sf, "embeddings").select("vec_id", "embedding", F.col("label").alias("category"))
    near = S.near_duplicates(vectors(spark, sf), known, "vec_id", "vec_id", skip_same=True)
    rows = near.select("vec_id", "nearest_category", "is_near_duplicate").join(
        class_shares(spark, sf).withColumnRenamed("o_custkey", "vec_id"), "vec_id"
    )
    done = D.prompt_decisions(rows, "p", CLASSES)
    marks = ["is_near_duplicate", "risk_tier_upgraded", "quarantine_triggered"]
    return done.select("vec_id", "label", "confidence", "risk_tier", "nearest_category", "final_tier", *[F.col(c).cast("int").alias(c) for c in marks])


# --- sections and text index ---------------------------------------------------------------------

PIECES_SQL = """
piece AS (
  SELECT page_id, url, generate_subscripts(cut, 1) - 1 AS section_no, unnest(cut) AS piece
  FROM (SELECT page_id, url, string_split(html, '<p>') AS cut FROM pages)),
sec AS (
  SELECT page_id, url, section_no, trim(split_part(piece, '</p>', 1)) AS title,
         trim(substr(piece, length(split_part(piece, '</p>', 1)) + 5)) AS text FROM piece),
hashed AS (SELECT *, sha256(title || chr(31) || text) AS content_hash FROM sec)"""


def page_sections(spark, sf):
    pages = table(spark, sf, "pages")
    cut = S.sections(pages, "page_id", "html", heading="<p>", title_end="</p>")
    return cut.withColumn("content_hash", S.content_hash("title", "text"))


@query("section_index", f"WITH {PIECES_SQL} SELECT page_id, section_no, content_hash FROM hashed")
def section_index(spark, sf):
    return page_sections(spark, sf).select("page_id", "section_no", "content_hash")


@query(
    "section_refresh",
    f"""WITH {PIECES_SQL}, stored AS (SELECT content_hash FROM hashed WHERE url LIKE '%/en/%')
SELECT content_hash, min(page_id * 100000 + section_no) AS first_place FROM hashed
WHERE content_hash NOT IN (SELECT content_hash FROM stored) GROUP BY content_hash""",
)
def section_refresh(spark, sf):
    """Sections that an index of the English pages does not hold yet, one per content."""
    every = page_sections(spark, sf).select("page_id", "section_no", "content_hash")
    english = table(spark, sf, "pages").filter(F.col("url").contains("/en/")).select("page_id")
    index = stored(every.join(english, "page_id", "left_semi"), "sections")
    fresh = S.refresh_index(index, every)
    return fresh.select("content_hash", (F.col("page_id") * 100000 + F.col("section_no")).alias("first_place"))


@query("text_index_retrieval")
def text_index_retrieval(spark, sf):
    """Do spaced-out variants of the known texts still find their original in the index?"""
    items = table(spark, sf, "benchmark")
    model = S.text_vectors().fit(items)
    index = S.embed(model, items).select(F.col("item_id").alias("known_id"), "embedding")
    asked = C.variants(items, "text", "item_id", ["spaced_out"]).select(
        "item_id", F.col("item_id").alias("expected"), F.col("variant").alias("text")
    )
    hits = S.nearest(S.embed(model, asked), index, "item_id", "known_id", k=3)
    return S.hit_rate(hits, asked, "item_id", "known_id", "expected")


# --- model jobs ----------------------------------------------------------------------------------

INPUTS = ["value", "k", "value_zscore", "k_zscore", "value_change", "value_per_k"]


def labelled_features(spark, sf):
    """Rolling features of the events, labelled by the truth windows."""
    from tidewatch.operators import incidents as I

    done = M.fill_gaps(M.rolling_features(
        metric_events(spark, sf), ["event_type"], ORDER, ROLLED, group_rows=bound(spark, sf, "events", "event_type"), **EXTRA
    ))
    return I.label_by_windows(done, truth_windows(spark, sf), "event_type", "ts")


def stored_scores(spark, sf):
    """The ensemble's score table, written once."""
    rows = Mo.ensemble_scores(labelled_features(spark, sf), INPUTS, "event_id", "is_anomaly")
    columns = ["event_id", "event_type", "ts", "is_anomaly", "iso_score", "svm_score", "ae_rmse"]
    return stored(rows.select(*columns), "scores")


@query("ensemble_scores")
def ensemble_scores(spark, sf):
    return stored_scores(spark, sf)


def model_inputs(spark, sf):
    """Scaled inputs as columns and as one array, stored because the fits pass over them many times."""
    rows = labelled_features(spark, sf).select("event_id", "is_anomaly", *INPUTS)
    names = [f"s{i}" for i in range(len(INPUTS))]
    scaled = M.standard_scaled(rows, rows, dict(zip(INPUTS, names))).withColumn("x", F.array(*names))
    return stored(scaled.select("event_id", "is_anomaly", "x", *names), "inputs"), names


@query("isolation_scores")
def isolation_scores(spark, sf):
    rows, _ = model_inputs(spark, sf)
    forest = Mo.fit_isolation_forest(rows, "x", "event_id")
    return Mo.isolation_scores(rows, forest, "x").select("event_id", "iso_score")


@query("one_class_scores")
def one_class_scores(spark, sf):
    rows, _ = model_inputs(spark, sf)
    rate = rows.agg(F.avg("is_anomaly")).first()[0]
    return Mo.one_class_scores(rows, Mo.fit_one_class(rows, "x", rate), "x").select("event_id", "svm_score")


@query("reconstruction_error")
def reconstruction_error(spark, sf):
    rows, names = model_inputs(spark, sf)
    fitted = Mo.fit_reconstruction(rows, names, F.col("is_anomaly") == 0)
    return Mo.reconstruction_error(rows, names, fitted).select("event_id", "ae_rmse")


@query(
    "autoencoder_fit",
    "SELECT count(*) AS scored, true AS beats_plane, true AS all_finite FROM events",
)
def autoencoder_fit(spark, sf):
    """Does the net reconstruct normal rows better than their principal plane, and score every row?"""
    rows, names = model_inputs(spark, sf)
    normal = F.col("is_anomaly") == 0
    net = Mo.fit_autoencoder(rows, names, normal)
    plane = Mo.reconstruction_error(rows, names, Mo.fit_reconstruction(rows, names, normal), "plane")
    both = Mo.autoencoder_error(plane, names, net)
    mean = lambda c: F.avg(F.when(normal, F.col(c) * F.col(c)))
    return both.agg(
        F.count("*").alias("scored"), (mean("ae_rmse") < mean("plane")).alias("beats_plane"),
        F.every(F.col("ae_rmse").isNotNull() & (F.col("ae_rmse") < float("inf"))).alias("all_finite"),
    )


@query("autoencoder_error")
def autoencoder_error(spark, sf):
    rows, names = model_inputs(spark, sf)
    return Mo.autoencoder_error(rows, names, Mo.fit_autoencoder(rows, names, F.col("is_anomaly") == 0)).select("event_id", "ae_rmse")


@query(
    "one_class_fit",
    "SELECT count(*) AS scored, true AS gap_is_small, true AS outside_is_bounded FROM events",
)
def one_class_fit(spark, sf):
    """Is the boundary near its optimum, and are no more rows outside than it may leave there?"""
    rows, _ = model_inputs(spark, sf)
    rate = rows.agg(F.avg("is_anomaly")).first()[0]
    model = Mo.fit_one_class(rows, "x", rate)
    outside = F.count_if(F.col("svm_score") > 1e-9)
    return Mo.one_class_scores(rows, model, "x").agg(
        F.count("*").alias("scored"), F.lit(model.gap <= 0.02).alias("gap_is_small"),
        (outside <= F.lit(Mo.outside_share(rate)) * F.count("*")).alias("outside_is_bounded"),
    )


@query("ensemble_metrics")
def ensemble_metrics(spark, sf):
    """Calibrated threshold and metrics per model, and of the agreement rule."""
    scores = stored_scores(spark, sf)
    models = {}
    for name, column in (("isolation_forest", "iso_score"), ("one_class_svm", "svm_score"), ("autoencoder", "ae_rmse")):
        best = E.best_percentile(E.percentile_sweep(scores, "is_anomaly", column)).first()
        models[name] = (column, float(best["threshold"]))
    board = E.model_comparison(scores, "is_anomaly", models)
    scaled = M.min_max(scores, {"iso_score": "_iso", "ae_rmse": "_ae"})
    agreed = scaled.withColumn("severity", D.agreement_severity(F.col("_iso"), F.col("_ae")))
    rule = E.binary_metrics(agreed, "is_anomaly", F.col("severity") != "low")
    rule = rule.select(
        F.lit("agreement").alias("model"), F.lit(3).alias("place"),
        *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], F.lit(None).cast("double").alias("roc_auc"),
    )
    return board.unionByName(rule)


def labelled_vectors(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("category", F.concat(F.lit("label-"), "label"))
    split = C.stratified_split(rows, "category", "vec_id", group_rows=bound(spark, sf, "embeddings", "label"))
    scaled = M.standard_scaled_array(split, split.filter(F.col("split") == "train"), "embedding", "scaled")
    ready = scaled.select("vec_id", "category", "split", array_to_vector("scaled").alias("features"))
    # the fits pass over these rows many times
    return stored(Mo.label_index(ready, "category").select("vec_id", "category", "split", "label", "features"))


@query("logistic_report")
def logistic_report(spark, sf):
    """Multinomial regression on scaled vectors, report on the test split."""
    rows = labelled_vectors(spark, sf)
    train = rows.filter(F.col("split") == "train")
    model = Mo.multinomial(train.count()).fit(train)
    return E.class_report(model.transform(rows.filter(F.col("split") == "test")), "label", "prediction")


@query("multiclass_boosting_report")
def multiclass_boosting_report(spark, sf):
    """Softmax boosting at its stated size, report on the test split."""
    rows = labelled_vectors(spark, sf)
    classes = rows.agg(F.max("label")).first()[0]
    model = Mo.multiclass_boosted(rows.filter(F.col("split") == "train"), int(classes) + 1)
    return E.class_report(Mo.classified(rows.filter(F.col("split") == "test"), model), "label", "prediction")


@query("label_index", "SELECT vec_id, dense_rank() OVER (ORDER BY 'label-' || label) - 1.0 AS label FROM embeddings")
def label_index(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.concat(F.lit("label-"), "label").alias("category"))
    return Mo.label_index(rows, "category").select("vec_id", "label")
