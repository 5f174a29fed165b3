"""Quality rules: robust multivariate outliers.

Each document is a vector of transformed statistics. For each language and source the
minimum-covariance-determinant estimate of centre and scatter is found by concentration steps from two deterministic starts:
medians with median deviations, and the moments of all rows. A step keeps the three quarters of the rows that lie nearest and
estimates mean and covariance from them; steps go on until no group's sums change (at most MOST_STEPS). Of the two ends the one with the
smaller determinant counts. A document is rejected by its Mahalanobis distance from it.

Statistics are rounded to thousandths and distances to hundredths, as integers. Sums and
percentiles are then exact, whatever the partitioning, and a percentile's buffer has a bounded number
of distinct values. Only group-level rows (a few dozen numbers for each language and source) are
kept between steps; rows are never gathered. Everything here is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.common import WORD, documents, nullsafe, settle, text_of, words_of

#: Least standard deviation of each statistic, in thousandths, added to every scatter: for statistics that are constant in clean text.
FLOORS = (500, 50, 350, 100, 100)
P = len(FLOORS)
#: The share of rows that the estimate rests on, and the factor that makes its scatter consistent for normal data with P = 5.
SHARE, CONSISTENT = 0.75, 1.41
#: Squared distances above this reject: the 0.999999 quantile of chi-square with 5 degrees of freedom.
CUTOFF = 35.89
MOST_STEPS = 10
#: Groups with fewer rows are pooled by language, pools with fewer over all languages.
LEAST_ROWS = 8
#: Group-level tables of up to so many rows are broadcast; larger ones meet the rows in a shuffle.
MOST_BROADCAST = 100_000
POOL = "~"
#: Squared distances are counted in hundredths up to this.
MOST_BIN = 100_000
WINDOW = 8
GROUP = ["lang_key", "source_key"]
#: The group whose estimate counts for a row, and the start that an estimate comes from.
POOLED = ["pool_lang", "pool_source"]
EACH = [*POOLED, "start"]


def without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def base_statistics(docs: DataFrame, carry: list[str]) -> DataFrame:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed of each row.

    Null texts count as empty: all numbers 0, base_failed true.
    """
    text = text_of()
    rows = docs.select(*carry, text.alias("whole")).withColumn("words", words_of(F.col("whole")))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    whole = F.col("whole")
    rows = rows.select(
        *carry,
        "n_words",
        F.length(without(whole, " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(without(whole, "#*$%&|<>"))).cast("long").alias("n_symbols"),
        F.filter(F.split("whole", "\n"), lambda x: F.rlike(x, F.lit(WORD))).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # Hashes of 1 word become hashes of 2, 4 and 8 words: each pass pairs an array with itself, moved.
    for step in (1, 2, 4):
        moved = F.expr(f"slice(hashes, {step + 1}, greatest(size(hashes) - {step}, 0))")
        pairs = F.zip_with(F.expr(f"slice(hashes, 1, greatest(size(hashes) - {step}, 0))"), moved, lambda a, b: F.xxhash64(a, b))
        rows = rows.withColumn("hashes", pairs)
    rows = rows.withColumn("n_lines", F.size("lines").cast("long")).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    # Only rows with a repeated window are sorted: (hash, position), then neighbours with equal hashes.
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("sorted_windows", F.when(repeated, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    both = F.zip_with(F.expr("slice(sorted_windows, 2, size(sorted_windows) - 1)"), F.expr("slice(sorted_windows, 1, size(sorted_windows) - 1)"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.expr("cast(array() as array<int>)")))
    rows = rows.withColumn("starts", F.array_sort(F.array_distinct(F.flatten(both))))
    covered = F.aggregate(F.zip_with(F.expr("slice(starts, 2, size(starts) - 1)"), F.expr("slice(starts, 1, size(starts) - 1)"), lambda b, a: F.least(F.lit(WINDOW), b - a)), F.lit(WINDOW), lambda s, x: s + x)
    rows = rows.withColumn("n_repeat_words", F.when(F.col("starts").isNull(), F.lit(0)).otherwise(covered).cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return rows.select(*carry, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"))


#: The transformed statistics, as SQL that Spark and the oracle share. Null where the base rules fail.
STATISTICS = tuple(
    f"CAST(CASE WHEN base_failed THEN NULL ELSE round(1000 * {x}) END AS BIGINT)"
    for x in (
        "ln(1 + CAST(n_words AS DOUBLE))",
        "ln(CAST(word_chars AS DOUBLE) / greatest(n_words, 1))",
        "ln(1 + 100 * CAST(n_symbols AS DOUBLE) / greatest(word_chars, 1))",
        "(CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1))",
        "(CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1))",
    )
)
ENTRIES = [(i, j) for i in range(P) for j in range(i + 1)]
#: Sums over the rows that an estimate rests on.
SUMS = ["CAST(count(*) AS BIGINT) AS n_used", *(f"CAST(sum(x{i}) AS DOUBLE) AS s{i}" for i in range(P)), *(f"CAST(sum(x{i} * x{j}) AS DOUBLE) AS q{i}{j}" for i, j in ENTRIES)]
#: Mean and consistent covariance, with the floors' squares on the diagonal.
MOMENTS = [*(f"s{i} / n_used AS m{i}" for i in range(P)), *(f"{CONSISTENT} * ((q{i}{j} - s{i} * s{j} / n_used) / n_used){f' + {FLOORS[i] ** 2}' if i == j else ''} AS c{i}{j}" for i, j in ENTRIES)]


def cholesky() -> list[list[str]]:
    """The lower factor's columns as SQL over c: lists whose entries use earlier lists only."""
    out = []
    for j in range(P):
        less = "".join(f" - l{j}{k} * l{j}{k}" for k in range(j))
        out.append([f"sqrt(c{j}{j}{less}) AS l{j}{j}"])
        if j + 1 < P:
            out.append([f"(c{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, P)])
    return out


def solve() -> list[list[str]]:
    """z with L z = x - m, entry after entry."""
    return [[f"(x{i} - m{i}{''.join(f' - l{i}{k} * z{k}' for k in range(i))}) / l{i}{i} AS z{i}"] for i in range(P)]


#: Doubles on both sides: a literal like 1.41 is a decimal in Spark's SQL.
def as_double(sql: str) -> str:
    return sql.replace(f"{CONSISTENT} *", f"CAST({CONSISTENT} AS DOUBLE) *")


DISTANCE = " + ".join(f"z{i} * z{i}" for i in range(P))
FACTOR = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i, j in ENTRIES]


def binned(d2: str) -> str:
    return f"CAST(least(floor(100 * ({d2})), {MOST_BIN}) AS BIGINT)"


def extended(df: DataFrame, levels: list[list[str]]) -> DataFrame:
    for level in levels:
        df = df.selectExpr("*", *map(as_double, level))
    return df


def attach(rows: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a settled table of groups to the rows. Its size is counted first: a small one is broadcast, so that no rows are shuffled."""
    return rows.join(F.broadcast(small) if small.count() <= MOST_BROADCAST else small, on, how)


def pools(rows: DataFrame) -> DataFrame:
    """The group whose estimate counts for each language and source: its own, its language's small ones together, or all that is then left."""
    sizes = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    small = F.col("n") < LEAST_ROWS
    own = sizes.withColumn("pool_source", F.when(small, POOL).otherwise(F.col("source_key")))
    pool = own.groupBy("lang_key", "pool_source").agg(F.sum("n").alias("n_pool"))
    named = own.join(pool, ["lang_key", "pool_source"]).withColumn("pool_lang", F.when(F.col("n_pool") < LEAST_ROWS, POOL).otherwise(F.col("lang_key")))
    return settle(named.select(*GROUP, *POOLED), "pools")


def median_start(rows: DataFrame) -> DataFrame:
    """d_bin of start 1: distance from the medians in units of the median deviations, floors included."""
    medians = settle(rows.groupBy(*POOLED).agg(*[F.percentile(f"x{i}", F.lit(0.5)).alias(f"med{i}") for i in range(P)]), "medians")
    near = attach(rows, medians, POOLED)
    spread = settle(near.groupBy(*POOLED).agg(*[F.percentile(F.abs(F.col(f"x{i}") - F.col(f"med{i}")), F.lit(0.5)).alias(f"mad{i}") for i in range(P)]), "deviations")
    return attach(near, spread, POOLED).selectExpr(*rows.columns, "1 AS start", binned(START) + " AS d_bin")


START = " + ".join(f"((x{i} - med{i}) / greatest(mad{i} * 1.4826D, {f})) * ((x{i} - med{i}) / greatest(mad{i} * 1.4826D, {f}))" for i, f in enumerate(FLOORS))
#: The square root of the determinant.
DETERMINANT = " * ".join(f"l{i}{i}" for i in range(P))
RAW = ["n_used", *(f"s{i}" for i in range(P)), *(f"q{i}{j}" for i, j in ENTRIES)]


def factors_of(used: DataFrame) -> DataFrame:
    """Sums to means and factors of the scatter."""
    return extended(used.selectExpr("*", *map(as_double, MOMENTS)), cholesky()).select(*EACH, "n_rows", *RAW, *FACTOR)


def distances(rows: DataFrame, factors: DataFrame) -> DataFrame:
    return extended(attach(rows, factors.select(*EACH, *FACTOR), POOLED), solve()).selectExpr(*rows.columns, "start", binned(DISTANCE) + " AS d_bin")


def estimate(rows: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimate of each pool: means m and factors l of the scatter. rows: POOLED and the statistics."""
    everything = rows.withColumn("start", F.lit(2)).groupBy(*EACH).agg(F.count(F.lit(1)).alias("n_rows"), *map(F.expr, SUMS))
    near, last = median_start(rows).unionByName(distances(rows, settle(factors_of(everything), "factors"))), None
    for step in range(MOST_STEPS):
        cut = settle(near.groupBy(*EACH).agg(F.percentile("d_bin", F.lit(SHARE)).alias("cut"), F.count(F.lit(1)).alias("n_rows")), f"cut{step}")
        used = attach(near, cut, EACH).where("d_bin <= cut").groupBy(*EACH).agg(F.min("n_rows").alias("n_rows"), *map(F.expr, SUMS))
        factors = settle(factors_of(used), f"factors{step}")
        if last is not None and factors.select(*EACH, *RAW).exceptAll(last.select(*EACH, *RAW)).isEmpty():
            break
        near, last = distances(rows, factors), factors
    best = factors.groupBy(*POOLED).agg(F.min(F.struct(F.expr(DETERMINANT).alias("det"), "start", "n_rows", *FACTOR)).alias("b"))
    return settle(best.select(*POOLED, "b.n_rows", *[f"b.{x}" for x in FACTOR]), "estimate")


def quality(docs: DataFrame, carry: list[str]) -> DataFrame:
    """The base statistics, base_failed and kept of each row, with the columns in carry.

    A row that fails the base rules (under 20 words, or over 30 % of its words in repeated
    8-word windows) is not kept and has no part in any estimate. Others are kept unless their
    squared distance exceeds CUTOFF. Null languages and sources form groups of their own. Groups of
    under LEAST_ROWS rows are judged with their language's other small ones, and those with all that is left; if that is still
    under LEAST_ROWS rows, they are kept. An empty table stays empty.
    """
    judged = docs.select(*carry, "text", nullsafe("lang").alias("lang_key"), nullsafe("source").alias("source_key"))
    return judge(base_statistics(judged, [*carry, *GROUP]))


def judge(rows: DataFrame) -> DataFrame:
    """Base statistics with the method's verdict, kept."""
    rows = settle(rows.selectExpr("*", *(f"{x} AS x{i}" for i, x in enumerate(STATISTICS))), "statistics")
    clean = rows.where("NOT base_failed").select(*GROUP, *[f"x{i}" for i in range(P)])
    pooled = pools(clean)
    factors = estimate(attach(clean, pooled, GROUP).drop(*GROUP))
    of_group = settle(pooled.join(factors, POOLED).drop(*POOLED), "factors")
    far = extended(attach(rows, of_group, GROUP, "left"), solve()).withColumn("d2", F.expr(DISTANCE))
    kept = ~F.col("base_failed") & F.coalesce((F.col("n_rows") < LEAST_ROWS) | (F.col("d2") <= CUTOFF), F.lit(True))
    return far.withColumn("kept", kept)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that quality() keeps, with the columns of docs.

    Rows travel with their statistics, in a struct apart from them: they are written once and never shuffled.
    """
    judged = docs.select("text", F.struct(*docs.columns).alias("judged_row"), nullsafe("lang").alias("lang_key"), nullsafe("source").alias("source_key"))
    return judge(base_statistics(judged, ["judged_row", *GROUP])).where("kept").select("judged_row.*")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict on every document."""
    return quality(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def oracle() -> str:
    nullsafes = "coalesce('=' || lang, '') AS lang_key, coalesce('=' || source, '') AS source_key"
    by, each = ", ".join(POOLED), ", ".join(EACH)
    out = [
        rf"""base AS (
  SELECT doc_id, {nullsafes}, coalesce(text, '') AS whole, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
lined AS (SELECT *, list_filter(string_split(whole, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM base),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c
  FROM (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS w FROM base WHERE len(words) >= 8)),
hits AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM windows WHERE c > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM hits GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang_key, source_key, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(whole) - length(regexp_replace(whole, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM lined LEFT JOIN covered c USING (doc_id)),
failed AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM counted),
judged AS (SELECT *, {', '.join(f'{x} AS x{i}' for i, x in enumerate(STATISTICS))} FROM failed),
sizes AS (SELECT lang_key, source_key, CASE WHEN count(*) < {LEAST_ROWS} THEN '{POOL}' ELSE source_key END AS pool_source, count(*) AS n FROM judged WHERE NOT base_failed GROUP BY lang_key, source_key),
pools AS (SELECT lang_key, source_key, CASE WHEN sum(n) OVER (PARTITION BY lang_key, pool_source) < {LEAST_ROWS} THEN '{POOL}' ELSE lang_key END AS pool_lang, pool_source FROM sizes),
rows AS (SELECT j.*, pool_lang, pool_source FROM judged j LEFT JOIN pools USING (lang_key, source_key))""",
        f"medians AS (SELECT {by}, {', '.join(f'quantile_cont(x{i}, 0.5) AS med{i}' for i in range(P))} FROM rows WHERE NOT base_failed GROUP BY ALL)",
        f"spread AS (SELECT {by}, {', '.join(f'quantile_cont(abs(x{i} - med{i}), 0.5) AS mad{i}' for i in range(P))} FROM rows JOIN medians USING ({by}) WHERE NOT base_failed GROUP BY ALL)",
        f"moments_0 AS (SELECT *, {', '.join(map(as_double, MOMENTS))} FROM (SELECT {by}, {', '.join(SUMS)} FROM rows WHERE NOT base_failed GROUP BY ALL))",
    ]

    def levels(name: str, levels: list[list[str]]) -> str:
        """CTEs name_0, name_1, ... each with one more level."""
        for k, level in enumerate(levels):
            out.append(f"{name}_{k + 1} AS (SELECT *, {', '.join(map(as_double, level))} FROM {name}_{k})")
        return f"{name}_{len(levels)}"

    last = levels("moments", cholesky())
    out.append(f"begin_0 AS (SELECT rows.*, {', '.join(FACTOR)} FROM rows JOIN {last} USING ({by}) WHERE NOT base_failed)")
    last = levels("begin", solve())
    numbers = ", ".join([*POOLED, *(f"x{i}" for i in range(P))])
    out.append(
        f"""near0 AS (SELECT {numbers}, 1 AS start, {binned(START.replace('1.4826D', 'CAST(1.4826 AS DOUBLE)'))} AS d_bin FROM rows JOIN medians USING ({by}) JOIN spread USING ({by}) WHERE NOT base_failed
  UNION ALL SELECT {numbers}, 2, {binned(DISTANCE)} FROM {last})"""
    )
    for step in range(MOST_STEPS):
        out.append(f"cut{step} AS (SELECT {each}, quantile_cont(d_bin, {SHARE}) AS cut, count(*) AS n_rows FROM near{step} GROUP BY ALL)")
        out.append(f"used{step} AS (SELECT {each}, min(n_rows) AS n_rows, {', '.join(SUMS)} FROM near{step} JOIN cut{step} USING ({each}) WHERE d_bin <= cut GROUP BY ALL)")
        out.append(f"chol{step}_0 AS (SELECT *, {', '.join(map(as_double, MOMENTS))} FROM used{step})")
        last = levels(f"chol{step}", cholesky())
        out.append(f"factors{step} AS (SELECT {each}, n_rows, {', '.join(FACTOR)} FROM {last})")
        out.append(f"far{step}_0 AS (SELECT {numbers}, start, {', '.join(FACTOR)} FROM rows JOIN factors{step} USING ({by}) WHERE NOT base_failed)")
        last = levels(f"far{step}", solve())
        out.append(f"near{step + 1} AS (SELECT {numbers}, start, {binned(DISTANCE)} AS d_bin FROM {last})")
    out.append(f"best AS (SELECT * FROM factors{MOST_STEPS - 1} QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY {DETERMINANT}, start) = 1)")
    out.append(f"judged_0 AS (SELECT rows.*, f.n_rows, {', '.join('f.' + x for x in FACTOR)} FROM rows LEFT JOIN best f USING ({by}))")
    last = levels("judged", solve())
    return "WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in out) + f"\nSELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(n_rows < {LEAST_ROWS} OR {DISTANCE} <= {CUTOFF}, true) AS kept FROM {last}"


ORACLE = oracle()
