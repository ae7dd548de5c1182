"""Curation of labelled text corpora."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.functions import text as X
from tidewatch.operators.metrics import corpus_zscore
from tidewatch.operators.ordered import MAX_GROUP_ROWS, fits, largest_group
from tidewatch.session import stored

LIST_ROWS = 10_000


def labelled(df: DataFrame, text: str, is_attack: Column, source: str) -> DataFrame:
    """``text, is_attack, source`` with blanks stripped and empty texts dropped."""
    stripped = X.strip(F.col(text).cast("string"))
    rows = df.select(stripped.alias("text"), is_attack.alias("is_attack"), F.lit(source).alias("source"))
    return rows.filter(F.col("text") != "")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def keep_first(df: DataFrame, text: str, order: Sequence[str]) -> DataFrame:
    """The first row of each distinct text. Copies are cut to one per map task before the shuffle
    (a group limit under ``row_number() = 1``), so a text that fills a third of the table is fine;
    the shuffle key is a digest, not the text."""
    first = Window.partitionBy("_digest").orderBy(*order)
    return (
        df.withColumn("_digest", F.sha2(F.col(text), 256))
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") == 1)
        .drop("_rn", "_digest")
    )


def category_shares(df: DataFrame, *keys: str) -> DataFrame:
    total = df.agg(F.count("*")).scalar()
    counted = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / total, 6))


def categorised(
    corpus: DataFrame,
    text: str = "text",
    is_attack: str = "is_attack",
    normalise: bool = True,
    **keyword_lists: Sequence[str],
) -> DataFrame:
    """Adds ``category``. Obfuscation is looked for on the NFKD form, which only differs from the
    text on non-ASCII rows, so only those go through Python."""
    if not normalise:
        return corpus.withColumn(
            "category",
            X.rule_category(F.col(text), F.col(is_attack), X.is_obfuscated(F.col(text)), **keyword_lists),
        )
    # an ASCII text is sent as null: nothing to normalise, nothing to copy
    folded = corpus.withColumn("_nfkd", X.nfkd(F.when(~X.is_ascii(F.col(text)), F.col(text))))
    form = F.coalesce("_nfkd", F.col(text))
    return folded.withColumn(
        "category", X.rule_category(F.col(text), F.col(is_attack), X.is_obfuscated(form), **keyword_lists)
    ).drop("_nfkd")


def curated(sources: Sequence[DataFrame], order: Sequence[str], **options) -> DataFrame:
    """Union, first copy of each text, admission by length, category."""
    rows = keep_first(union_all(sources), "text", order)
    return categorised(rows.filter(X.admitted(F.col("text"))), **options)


def top_up(
    corpus: DataFrame,
    candidates: DataFrame,
    category: str,
    order: Sequence[str],
    floor: int = V.CATEGORY_FLOOR,
) -> DataFrame:
    """Candidates that lift each category to ``floor`` rows, in candidate order.

    At most ``floor`` candidates per category are kept by every map task before the shuffle.
    """
    ranked = candidates.withColumn("_rn", F.row_number().over(Window.partitionBy(category).orderBy(*order)))
    present = corpus.groupBy(category).agg(F.count("*").alias("_have"))
    return (
        ranked.filter(F.col("_rn") <= floor)
        .join(present, category, "left")
        .filter(F.col("_rn") <= floor - F.coalesce("_have", F.lit(0)))
        .drop("_rn", "_have")
    )


def balanced(
    corpus: DataFrame, candidates: DataFrame, category: str, text: str, order: Sequence[str], floor: int = V.CATEGORY_FLOOR
) -> DataFrame:
    """Corpus topped up to the floor, without repeated texts; corpus rows come first."""
    added = top_up(corpus, candidates, category, order, floor)
    both = corpus.withColumn("_part", F.lit(0)).unionByName(added.withColumn("_part", F.lit(1)))
    return keep_first(both, text, ["_part", *order]).drop("_part")


def variants(df: DataFrame, text: str, key: str, techniques: Sequence[str], seed: int = 42) -> DataFrame:
    """One row per text and technique, without copies of one another."""
    column, ident = F.col(text), F.col(key)
    makers = {
        "leetspeak": X.leetspeak(column),
        "zero_width": X.zero_width(column, ident, seed),
        "spaced_out": X.spaced_out(column, ident, seed),
        "base64": X.base64_wrap(column),
        "lookalikes": X.lookalikes(column),
    }
    made = F.array(*[F.struct(F.lit(t).alias("technique"), makers[t].alias("variant")) for t in techniques])
    exploded = df.withColumn("_made", F.explode(made))
    return exploded.select(*df.columns, "_made.technique", "_made.variant")


def template_grid(parts: Mapping[str, Sequence[str] | DataFrame], template: Column) -> DataFrame:
    """Every combination of the parts put into the template, distinct texts.

    A part is a list or a table of any size, of which the distinct values count. The grid is a product by
    definition: the largest table stays where it is and meets the others, which go to every task where a count
    shows that they are short.
    """
    spark = next(p for p in parts.values() if isinstance(p, DataFrame)).sparkSession
    tables = []
    for name, values in parts.items():
        values = values if isinstance(values, DataFrame) else spark.createDataFrame([(v,) for v in values], "v string")
        distinct = stored(values.select(F.col(f"`{values.columns[0]}`").alias(name)).distinct(), "part")
        tables.append((distinct.count(), distinct))
    tables.sort(key=lambda t: -t[0])
    grid = tables[0][1]
    for n, other in tables[1:]:
        grid = grid.crossJoin(F.broadcast(other) if n <= LIST_ROWS else other)
    filled = X.fill_template(template, **{part: F.col(part) for part in parts})
    return grid.select(filled.alias("text")).distinct()


# --- repeatable samples --------------------------------------------------------------------------


def seeded_hash(seed: int, key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed).cast("string"), key.cast("string")))


def hash_rank(
    df: DataFrame,
    strata: Sequence[str],
    key: str,
    seed: int = 42,
    name: str = "rank",
    size: str | None = None,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """1-based rank by a seeded hash of the key within each stratum, and the stratum's size if named.

    A stratum larger than ``limit`` is cut by the leading hash digits, which spread evenly: ranks
    within a cut plus the sizes of the earlier cuts.
    """
    hashed = df.withColumn("_h", seeded_hash(seed, F.col(key)))
    if fits(df, strata, limit, group_rows):
        whole = Window.partitionBy(*strata)
        ranked = hashed.withColumn(name, F.row_number().over(whole.orderBy("_h", key)))
        return (ranked.withColumn(size, F.count("*").over(whole)) if size else ranked).drop("_h")
    digits = max(1, math.ceil(math.log(4 * largest_group(df, strata) / limit, 16)))
    cut = hashed.withColumn("_cut", F.substring("_h", 1, digits))
    local = cut.withColumn("_rn", F.row_number().over(Window.partitionBy("_cut", *strata).orderBy("_h", key)))
    # at most 16 ** digits rows per stratum
    sizes = cut.groupBy("_cut", *strata).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*strata).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select(
        "_cut", *strata, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*strata)).alias("_size"),
    ).toDF("_c", *[f"_s{i}" for i in range(len(strata))], "_before", "_size")
    same = F.col("_cut") == F.col("_c")
    for i, stratum in enumerate(strata):
        same = same & F.col(stratum).eqNullSafe(F.col(f"_s{i}"))
    joined = local.join(start, same).withColumn(name, F.col("_rn") + F.col("_before"))
    if size:
        joined = joined.withColumn(size, F.col("_size"))
    return joined.drop("_rn", "_before", "_size", "_cut", "_c", "_h", *[f"_s{i}" for i in range(len(strata))])


def stratified_split(
    df: DataFrame,
    stratum: str,
    key: str,
    held_percent: int = 30,
    test_percent_of_held: int = 50,
    seed: int = 42,
    limit: int = MAX_GROUP_ROWS,
    group_rows: int | None = None,
) -> DataFrame:
    """Adds ``split`` (train/val/test), exact shares per stratum, the same on every run."""
    ranked = hash_rank(df, [stratum], key, seed, "_rank", "_n", limit, group_rows)
    percent = lambda n, p: F.floor((n * p + 99) / 100)
    held = percent(F.col("_n"), held_percent)
    test = percent(held, test_percent_of_held)
    label = (
        F.when(F.col("_rank") <= F.col("_n") - held, "train")
        .when(F.col("_rank") <= F.col("_n") - test, "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", label).drop("_rank", "_n")


def match_counts(
    attacks: DataFrame, benign: DataFrame, key: str, seed: int = 42, limit: int = MAX_GROUP_ROWS, group_rows: int | None = None
) -> DataFrame:
    """Attacks and an equally large repeatable sample of the benign rows, labelled."""
    wanted = attacks.agg(F.count("*")).scalar()
    sample = hash_rank(benign, [], key, seed, "_rank", None, limit, group_rows).filter(F.col("_rank") <= wanted).drop("_rank")
    return attacks.withColumn("label", F.lit("attack")).unionByName(
        sample.withColumns({"label": F.lit("benign"), "category": F.lit("benign")})
    )


def numeric_text_features(df: DataFrame, key: str, text: str, lexicon: Sequence[str] = V.ROLEPLAY_LEXICON) -> DataFrame:
    """The five raw text features by key, as served for a single text."""
    column = F.col(text)
    return df.select(
        key,
        X.special_token_count(column).alias("special_token_count"),
        X.imperative_density(column).alias("imperative_verb_density"),
        X.lexicon_score(column, lexicon).alias("roleplay_lexicon_score"),
        X.text_length(column).alias("prompt_length_chars"),
        X.char_entropy(column).alias("char_entropy"),
    )


def training_text_features(df: DataFrame, key: str, text: str, lexicon: Sequence[str] = V.ROLEPLAY_LEXICON) -> DataFrame:
    """The feature table of a corpus: entropy and length as z-scores over the corpus."""
    # numbers only: the texts are read once, the statistics and the scores come from this table
    raw = stored(numeric_text_features(df, key, text, lexicon), "text-features")
    scored = corpus_zscore(
        raw, {"char_entropy": "char_entropy_anomaly_score", "prompt_length_chars": "prompt_length_zscore"}
    )
    return scored.drop("char_entropy", "prompt_length_chars")
