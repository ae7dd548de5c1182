"""Text features, rule categories and corpus curation over the document tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.functions import text as X
from tidewatch.operators import corpus as C
from tidewatch.operators import metrics as M
from tidewatch.plans.registry import bound, query, spread, table
from tidewatch.session import stored

# The role-play lexicon and the keyword lists hit no row of the test tables, so these queries pass
# lists with words that occur there.
LEXICON = ["the the", "and the", "with", "ering", "der die", "que la"]
ROLEPLAY = ["ering the", "que la", "der und"]
OVERRIDE = ["and the", "pour le", "und die"]
DIRECT = ["with"]

NATURAL = {"imperative_verb_density", "roleplay_lexicon_score"}


def lit(text):
    return "'" + text.replace("'", "''") + "'"


def hits_sql(lowered, tokens):
    one = "(length({l}) - length(replace({l}, {t}, ''))) // {n}"
    return " + ".join(one.format(l=lowered, t=lit(t.lower()), n=len(t)) for t in tokens)


VERBS_SQL = ", ".join(lit(v) for v in V.IMPERATIVE_VERBS)
WORDS_SQL = "regexp_extract_all(lower(text), '[a-zA-Z'']+')"
DENSITY_SQL = (
    f"coalesce(len(list_filter({WORDS_SQL}, lambda w: w IN ({VERBS_SQL}))) / nullif(len({WORDS_SQL}), 0), 0.0)"
)
LEXICON_SQL = f"({hits_sql('lower(text)', LEXICON)}) / greatest(length(text) / 100.0::DOUBLE, 1.0::DOUBLE)"
ENTROPY_SQL = """
chars AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents),
counted AS (SELECT doc_id, ch, count(*) AS c FROM chars WHERE ch <> '' GROUP BY doc_id, ch),
sized AS (SELECT doc_id, sum(c) AS n FROM counted GROUP BY doc_id),
entropy AS (
  SELECT d.doc_id, coalesce(e.h, 0.0) AS h FROM documents d LEFT JOIN (
    SELECT c.doc_id, -sum((c.c / s.n) * log2(c.c / s.n)) AS h
    FROM counted c JOIN sized s ON c.doc_id = s.doc_id GROUP BY c.doc_id) e ON d.doc_id = e.doc_id)"""


@query(
    "text_features",
    f"""SELECT doc_id, CAST({hits_sql('lower(text)', V.SPECIAL_TOKENS)} AS BIGINT) AS special_token_count,
       {DENSITY_SQL} AS imperative_verb_density,
       {LEXICON_SQL} AS roleplay_lexicon_score,
       length(text) AS prompt_length_chars,
       round((length(text) - avg(length(text)) OVER ()) / stddev_samp(length(text)) OVER (), 6) AS prompt_length_zscore
FROM documents""",
)
def text_features(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    text = F.col("text")
    raw = docs.select(
        "doc_id",
        X.special_token_count(text).cast("long").alias("special_token_count"),
        X.imperative_density(text).alias("imperative_verb_density"),
        X.lexicon_score(text, LEXICON).alias("roleplay_lexicon_score"),
        X.text_length(text).cast("long").alias("prompt_length_chars"),
    )
    # numbers only, so that the texts are read once
    done = M.corpus_zscore(stored(raw, "text-features"), {"prompt_length_chars": "prompt_length_zscore"})
    return done.withColumn("prompt_length_zscore", F.round("prompt_length_zscore", 6))


@query(
    "char_entropy_z",
    f"""WITH {ENTROPY_SQL}
SELECT doc_id, round(h, 6) AS char_entropy,
       round((h - avg(h) OVER ()) / stddev_samp(h) OVER (), 6) AS char_entropy_anomaly_score
FROM entropy""",
)
def char_entropy_z(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    entropy = stored(docs.select("doc_id", X.char_entropy(F.col("text")).alias("char_entropy")), "entropy")
    done = M.corpus_zscore(entropy, {"char_entropy": "char_entropy_anomaly_score"})
    return done.select("doc_id", *[F.round(c, 6).alias(c) for c in ("char_entropy", "char_entropy_anomaly_score")])


PHRASES = [*V.SPECIAL_TOKENS, *V.ROLEPLAY_LEXICON, *V.ROLEPLAY_KEYWORDS, *V.OVERRIDE_KEYWORDS, *V.DIRECT_KEYWORDS]
PLANTED_SQL = f"planted AS (SELECT doc_id, lang <> 'en' AS is_attack, text || ' ' || [{', '.join(lit(p) for p in PHRASES)}][doc_id % {len(PHRASES)} + 1] AS text FROM documents)"


def any_sql(words):
    return "(" + " OR ".join(f"contains(lower(text), {lit(w)})" for w in words) + ")"


@query(
    "default_word_lists",
    f"""WITH {PLANTED_SQL} SELECT doc_id, CAST({hits_sql('lower(text)', V.SPECIAL_TOKENS)} AS BIGINT) AS special_token_count,
       round({DENSITY_SQL}, 9) AS imperative_verb_density,
       round(({hits_sql('lower(text)', V.ROLEPLAY_LEXICON)}) / greatest(length(text) / 100.0::DOUBLE, 1.0::DOUBLE), 9) AS roleplay_lexicon_score,
       CASE WHEN NOT is_attack THEN 'benign' WHEN {any_sql(V.ROLEPLAY_KEYWORDS)} THEN 'roleplay' WHEN {any_sql(V.OVERRIDE_KEYWORDS)} THEN 'instruction_override'
         ELSE 'direct_injection' END AS category FROM planted""",
)
def default_word_lists(spark, sf):
    """The library's own lists on the documents, each with one of their phrases added."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("doc_id") % len(PHRASES) + 1).cast("int"))
    text = F.col("text")
    return docs.withColumn("text", F.concat(text, F.lit(" "), phrase)).select(
        "doc_id",
        X.special_token_count(text).cast("long").alias("special_token_count"),
        F.round(X.imperative_density(text), 9).alias("imperative_verb_density"),
        F.round(X.lexicon_score(text), 9).alias("roleplay_lexicon_score"),
        X.rule_category(text, F.col("lang") != "en", F.lit(False)).alias("category"),
    )


def four(expr):
    """Decimal rounding, so that a tie is a tie on both sides."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 12)), 4) AS DOUBLE)"


@query(
    "served_text_features",
    f"""WITH {ENTROPY_SQL}
SELECT d.doc_id, CAST({hits_sql('lower(text)', V.SPECIAL_TOKENS)} AS BIGINT) AS special_token_count,
       {four(DENSITY_SQL)} AS imperative_verb_density,
       {four(LEXICON_SQL)} AS roleplay_lexicon_score,
       {four('e.h')} AS char_entropy, length(text) AS prompt_length_chars
FROM documents d JOIN entropy e ON d.doc_id = e.doc_id""",
)
def served_text_features(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    done = C.numeric_text_features(docs, "doc_id", "text", LEXICON)
    places = ("imperative_verb_density", "roleplay_lexicon_score", "char_entropy")
    return done.withColumns({c: F.round(c, 4) for c in places}).withColumns(
        {c: F.col(c).cast("long") for c in ("special_token_count", "prompt_length_chars")}
    )


@query(
    "training_text_features",
    f"""WITH {ENTROPY_SQL}
SELECT d.doc_id, CAST({hits_sql('lower(text)', V.SPECIAL_TOKENS)} AS BIGINT) AS special_token_count,
       round({DENSITY_SQL}, 9) AS imperative_verb_density, round({LEXICON_SQL}, 9) AS roleplay_lexicon_score,
       round((e.h - avg(e.h) OVER ()) / stddev_samp(e.h) OVER (), 6) AS char_entropy_anomaly_score,
       round((length(text) - avg(length(text)) OVER ()) / stddev_samp(length(text)) OVER (), 6) AS prompt_length_zscore
FROM documents d JOIN entropy e ON d.doc_id = e.doc_id""",
)
def training_text_features(spark, sf):
    """The feature table that a model is trained on."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text"))
    done = C.training_text_features(docs, "doc_id", "text", LEXICON)
    places = {"imperative_verb_density": 9, "roleplay_lexicon_score": 9, "char_entropy_anomaly_score": 6, "prompt_length_zscore": 6}
    return done.select("doc_id", F.col("special_token_count").cast("long").alias("special_token_count"), *[F.round(c, n).alias(c) for c, n in places.items()])


BLANK_SQL = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
SPACED_SQL = r"([\p{L}\p{N}_]" + BLANK_SQL + r"){10,}"
SHARE_SQL = r"length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / greatest(length(text), 1)"
SIGNALS_SQL = {
    "non_ascii": f"{SHARE_SQL} > 0.15",
    "base64_run": "regexp_matches(text, '[A-Za-z0-9+/]{30,}={0,2}')",
    "digit_letter_digit": "regexp_matches(text, '[0-9][a-zA-Z][0-9]')",
    "spaced_letters": f"regexp_matches(text, '{SPACED_SQL}')",
}
OBFUSCATED_SQL = "(" + " OR ".join(SIGNALS_SQL.values()) + ")"


@query(
    "obfuscation_flags",
    "SELECT doc_id, " + ", ".join(f"({v})::INT AS {k}" for k, v in SIGNALS_SQL.items())
    + f", {OBFUSCATED_SQL}::INT AS obfuscated FROM documents",
)
def obfuscation_flags(spark, sf):
    docs = spread(table(spark, sf, "documents"))
    signals = X.obfuscation_signals(F.col("text"))
    return docs.select(
        "doc_id",
        *[v.cast("int").alias(k) for k, v in signals.items()],
        X.is_obfuscated(F.col("text")).cast("int").alias("obfuscated"),
    )


STRIP_SQL = f"regexp_replace(text, '^{BLANK_SQL}+|{BLANK_SQL}+$', '', 'g')"
CORPUS_SQL = f"""
raw AS (
  SELECT {STRIP_SQL} AS text, lang <> 'en' AS is_attack, 'documents' AS source, doc_id AS rid, 0 AS part FROM documents
  UNION ALL
  SELECT {STRIP_SQL}, role = 'user', 'conversations', conv_id * 1000 + turn, 1 FROM conversations
), corpus AS (SELECT * FROM raw WHERE text <> '')"""


def corpus(spark, sf):
    docs = spread(table(spark, sf, "documents")).withColumns({"rid": F.col("doc_id"), "part": F.lit(0)})
    talk = table(spark, sf, "conversations").withColumns(
        {"rid": F.col("conv_id") * 1000 + F.col("turn"), "part": F.lit(1)}
    )
    frames = []
    for df, attack, name in ((docs, F.col("lang") != "en", "documents"), (talk, F.col("role") == "user", "conversations")):
        kept = C.labelled(df.withColumn("_a", attack), "text", F.struct("_a", "rid", "part"), name)
        frames.append(kept.select("text", F.col("is_attack._a").alias("is_attack"), "source", "is_attack.rid", "is_attack.part"))
    return C.union_all(frames)


@query("corpus_ingest", f"WITH {CORPUS_SQL} SELECT source, rid, is_attack::INT AS is_attack, md5(text) AS text_md5 FROM corpus")
def corpus_ingest(spark, sf):
    return corpus(spark, sf).select("source", "rid", F.col("is_attack").cast("int").alias("is_attack"), F.md5("text").alias("text_md5"))


CATEGORY_SQL = f"""CASE WHEN NOT is_attack THEN 'benign' WHEN {OBFUSCATED_SQL} THEN 'obfuscation'
  WHEN {any_sql(ROLEPLAY)} THEN 'roleplay' WHEN {any_sql(OVERRIDE)} THEN 'instruction_override'
  ELSE 'direct_injection' END"""


@query(
    "rule_categories",
    f"""WITH {CORPUS_SQL}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY part, rid) AS rn FROM corpus)
SELECT source, rid, {CATEGORY_SQL} AS category FROM firsts WHERE rn = 1 AND length(text) > 3""",
)
def rule_categories(spark, sf):
    done = C.curated([corpus(spark, sf)], ["part", "rid"], normalise=False, roleplay=ROLEPLAY, override=OVERRIDE, direct=DIRECT)
    return done.select("source", "rid", "category")


@query("rule_categories_nfkd")
def rule_categories_nfkd(spark, sf):
    """As above on the NFKD form, which the check engine cannot compute; tested by brute force."""
    done = C.curated([corpus(spark, sf)], ["part", "rid"], roleplay=ROLEPLAY, override=OVERRIDE, direct=DIRECT)
    return done.select("source", "rid", "category")


@query("category_distribution", "SELECT lang, source, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY lang, source")
def category_distribution(spark, sf):
    return C.category_shares(table(spark, sf, "documents"), "lang", "source")


@query(
    "keep_first_texts",
    "SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1",
)
def keep_first_texts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    return C.keep_first(docs, "text", ["doc_id"]).select("doc_id", "lang", "source")


@query(
    "obfuscate_variants",
    f"""SELECT item_id, 'leetspeak' AS technique, translate(text, '{V.LEET_FROM}', '{V.LEET_TO}') AS variant FROM benchmark
UNION ALL SELECT item_id, 'base64', '{V.BASE64_PREFIX}' || base64(encode(text)) FROM benchmark
UNION ALL SELECT item_id, 'lookalikes', translate(text, '{V.LATIN}', '{V.LOOKALIKE}') FROM benchmark""",
)
def obfuscate_variants(spark, sf):
    made = C.variants(table(spark, sf, "benchmark"), "text", "item_id", ["leetspeak", "base64", "lookalikes"])
    return made.select("item_id", "technique", "variant")


@query("obfuscate_seeded")
def obfuscate_seeded(spark, sf):
    """Seeded insertions; taking them out again gives the text back (tested)."""
    made = C.variants(table(spark, sf, "benchmark"), "text", "item_id", ["zero_width", "spaced_out"])
    return made.select("item_id", "technique", "variant")


@query(
    "balance_topup",
    f"""WITH have AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
cand AS (
  SELECT doc_id, translate(text, '{V.LEET_FROM}', '{V.LEET_TO}') AS text, lang, 'synthetic' AS source,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
added AS (
  SELECT c.doc_id, c.text, c.lang, c.source FROM cand c JOIN have h ON c.lang = h.lang WHERE c.rn <= 200 - h.n),
both_parts AS (
  SELECT doc_id, text, lang, source, 0 AS part FROM documents UNION ALL SELECT doc_id, text, lang, source, 1 FROM added)
SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY part, doc_id) AS rn FROM both_parts) WHERE rn = 1""",
)
def balance_topup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    made = docs.withColumns({"text": X.leetspeak(F.col("text")), "source": F.lit("synthetic")})
    return C.balanced(docs, made, "lang", "text", ["doc_id"]).select("doc_id", "lang", "source")


@query(
    "template_grid",
    """SELECT DISTINCT 'Summarize ' || p_name || ' sales in ' || n_name || ' (' || r_name || ').' AS text
FROM part CROSS JOIN nation CROSS JOIN region""",
)
def template_grid(spark, sf):
    parts = {
        "item": table(spark, sf, "part").select("p_name"),
        "nation": table(spark, sf, "nation").select("n_name"),
        "region": table(spark, sf, "region").select("r_name"),
    }
    return C.template_grid(parts, F.lit("Summarize {item} sales in {nation} ({region})."))


SPLIT_SQL = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n
  FROM documents),
cuts AS (SELECT *, CAST(ceil(n * 0.3) AS BIGINT) AS held, CAST(ceil(ceil(n * 0.3) * 0.5) AS BIGINT) AS test FROM ranked),
split AS (SELECT *, CASE WHEN r <= n - held THEN 'train' WHEN r <= n - test THEN 'val' ELSE 'test' END AS split FROM cuts)"""


def split_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    return C.stratified_split(docs, "lang", "doc_id", group_rows=bound(spark, sf, "documents", "lang"))


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT doc_id, lang, split FROM split")
def stratified_split(spark, sf):
    return split_documents(spark, sf).select("doc_id", "lang", "split")


@query(
    "scaled_features",
    f"""WITH {SPLIT_SQL}, fit AS (SELECT avg(n_chars) AS m, stddev_pop(n_chars) AS s FROM split WHERE split = 'train')
SELECT doc_id, split, round((n_chars - m) / s, 6) AS scaled FROM split, fit""",
)
def scaled_features(spark, sf):
    rows = split_documents(spark, sf)
    done = M.standard_scaled(rows, rows.filter(F.col("split") == "train"), {"n_chars": "scaled"})
    return done.select("doc_id", "split", F.round("scaled", 6).alias("scaled"))


@query(
    "balanced_corpus",
    """WITH attack AS (SELECT item_id AS rid, text, 'benchmark' AS category FROM benchmark),
benign AS (
  SELECT doc_id AS rid, text, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents)
SELECT rid, category, 'attack' AS label FROM attack
UNION ALL SELECT rid, 'benign', 'benign' FROM benign WHERE r <= (SELECT count(*) FROM attack)""",
)
def balanced_corpus(spark, sf):
    attack = table(spark, sf, "benchmark").select(F.col("item_id").alias("rid"), "text", F.lit("benchmark").alias("category"))
    benign = table(spark, sf, "documents").select(F.col("doc_id").alias("rid"), "text")
    return C.match_counts(attack, benign, "rid", group_rows=bound(spark, sf, "documents")).select("rid", "category", "label")
