"""Queries over predictions and references: scores and regressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import chunks as C, metrics as M, regression as G
from .registry import ctes, query
from .tables import TAGGED, documents, table, tagged
from .task_queries import logits

# --- single labels ----------------------------------------------------------


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted and true class of each vector, the class of the largest of ten
    numbers moved to the truth for two thirds of the rows, and a weight."""
    best = F.array_position("logits", F.array_max("logits")) - 1
    return logits(spark, folder).select(
        F.when(F.col("index") % 3 == 0, best).otherwise(F.col("label")).cast("int").alias("p"),
        F.col("label").alias("r"),
        (1 + F.col("index") % 4).cast("double").alias("w"),
        (F.col("index") % 5).alias("run"),
    )


_PREDICTIONS = """
predictions AS (
  SELECT CASE WHEN vec_id % 3 = 0 THEN list_position(embedding, list_max(embedding)) - 1 ELSE label END AS p,
    label AS r, CAST(1 + vec_id % 4 AS DOUBLE) AS w, vec_id % 5 AS run FROM embeddings)
"""
_COUNTS = """
per_label AS (
  SELECT label, sum(CASE WHEN p = label AND r = label THEN w ELSE 0 END) AS tp,
    sum(CASE WHEN p = label THEN w ELSE 0 END) AS np, sum(CASE WHEN r = label THEN w ELSE 0 END) AS nr
  FROM predictions, (SELECT p AS label FROM predictions UNION SELECT r FROM predictions) GROUP BY label),
scores AS (SELECT *, CASE WHEN np + nr = 0 THEN 0 ELSE 2 * tp / (np + nr) END AS f1 FROM per_label)
"""


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 8) for c in columns})


@query("accuracy", ctes(_PREDICTIONS) + """
    SELECT run, round(avg(CASE WHEN p = r THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM predictions GROUP BY run""")
def accuracy(spark, folder):
    return _round(M.accuracy(predictions(spark, folder), "p", "r", by=("run",)), "accuracy")


@query("accuracy_weighted", ctes(_PREDICTIONS) + """
    SELECT round(sum(CASE WHEN p = r THEN w ELSE 0 END) / sum(w), 8) AS accuracy FROM predictions""")
def accuracy_weighted(spark, folder):
    return _round(M.accuracy(predictions(spark, folder), "p", "r", weight="w"), "accuracy")


@query("accuracy_count", ctes(_PREDICTIONS) + """
    SELECT CAST(count(*) FILTER (p = r) AS DOUBLE) AS accuracy FROM predictions""")
def accuracy_count(spark, folder):
    return M.accuracy(predictions(spark, folder), "p", "r", normalize=False)


def _register_f1(name: str, sql: str, **options) -> None:
    @query(f"f1_{name}", ctes(_PREDICTIONS, _COUNTS) + sql)
    def f1(spark, folder):
        return _round(M.f1(predictions(spark, folder), "p", "r", weight="w", **options), "f1")


_register_f1("binary", "SELECT round(f1, 8) AS f1 FROM scores WHERE label = 3", average="binary", pos_label=3)
_register_f1("macro", "SELECT round(avg(f1), 8) AS f1 FROM scores", average="macro")
_register_f1("micro", "SELECT round(2 * sum(tp) / (sum(np) + sum(nr)), 8) AS f1 FROM scores", average="micro")
_register_f1("weighted", "SELECT round(sum(f1 * nr) / sum(nr), 8) AS f1 FROM scores", average="weighted")
_register_f1("per_label", "SELECT CAST(label AS INTEGER) AS label, round(f1, 8) AS f1 FROM scores", average=None)
_register_f1(
    "chosen_labels",
    "SELECT round(sum(CASE WHEN label IN (1, 2) THEN f1 END) / 3, 8) AS f1 FROM scores",
    average="macro", labels=[1, 2, 77],
)


# --- multi-label ------------------------------------------------------------


def multi_label(spark: SparkSession, folder: str) -> DataFrame:
    """The two labels of a document against a rule on its length."""
    rows = table(spark, folder, "labels").join(documents(spark, folder).select("doc_id", "n_chars"), "doc_id")
    return rows.select(
        "doc_id",
        F.array("quality", "toxic").alias("r"),
        F.array((F.col("n_chars") > 1000).cast("int"), (F.col("n_chars") % 7 == 0).cast("int")).alias("p"),
    )


_MULTI = """
multi AS (
  SELECT l.doc_id, quality AS r0, toxic AS r1, CAST(n_chars > 1000 AS INTEGER) AS p0, CAST(n_chars % 7 = 0 AS INTEGER) AS p1
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
sides AS (
  SELECT 0 AS label, sum(p0 * r0) AS tp, sum(p0) AS np, sum(r0) AS nr FROM multi
  UNION ALL SELECT 1, sum(p1 * r1), sum(p1), sum(r1) FROM multi),
scores AS (SELECT *, CASE WHEN np + nr = 0 THEN 0 ELSE 2 * tp::DOUBLE / (np + nr) END AS f1 FROM sides)
"""


# Labels asked for by name, some of them absent in some runs and one in all.
_ASKED = [0, 1, 2, 40, 99]
_BY_RUN = """
runs AS (SELECT DISTINCT run FROM predictions),
asked AS (
  SELECT g.run, g.label, count(*) FILTER (p = label AND r = label) AS tp, count(*) FILTER (p = label) AS np,
    count(*) FILTER (r = label) AS nr
  FROM (SELECT run, unnest({labels}) AS label FROM runs) g JOIN predictions q ON q.run = g.run GROUP BY ALL),
by_run AS (SELECT run, label, CASE WHEN np + nr = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * tp / (np + nr) END AS f1 FROM asked)
"""


@query("f1_macro_by_run", ctes(_PREDICTIONS, _BY_RUN.format(labels=_ASKED)) + """
    SELECT run, round(avg(f1), 8) AS f1 FROM by_run GROUP BY run""")
def f1_macro_by_run(spark, folder):
    """Every run is averaged over all asked labels, also those it does not have."""
    rows = M.f1(predictions(spark, folder), "p", "r", average="macro", labels=_ASKED, by=("run",))
    return _round(rows, "f1")


@query("f1_binary_by_run", ctes(_PREDICTIONS, _BY_RUN.format(labels=[40])) + """
    SELECT run, round(f1, 8) AS f1 FROM by_run""")
def f1_binary_by_run(spark, folder):
    """A run without the positive label scores 0."""
    return _round(M.f1(predictions(spark, folder), "p", "r", pos_label=40, by=("run",)), "f1")


@query("f1_multilabel_macro", ctes(_MULTI) + "SELECT round(avg(f1), 8) AS f1 FROM scores")
def f1_multilabel_macro(spark, folder):
    return _round(M.f1(multi_label(spark, folder), "p", "r", average="macro"), "f1")


@query("f1_multilabel_micro", ctes(_MULTI) + """
    SELECT round(2 * sum(tp)::DOUBLE / (sum(np) + sum(nr)), 8) AS f1 FROM scores""")
def f1_multilabel_micro(spark, folder):
    return _round(M.f1(multi_label(spark, folder), "p", "r", average="micro"), "f1")


@query("f1_multilabel_samples", ctes(_MULTI) + """
    SELECT round(avg(CASE WHEN p0 + p1 + r0 + r1 = 0 THEN 0 ELSE 2 * (p0 * r0 + p1 * r1)::DOUBLE / (p0 + p1 + r0 + r1) END), 8) AS f1
    FROM multi""")
def f1_multilabel_samples(spark, folder):
    return _round(M.f1(multi_label(spark, folder), "p", "r", average="samples"), "f1")


@query("accuracy_multilabel", ctes(_MULTI) + """
    SELECT round(avg(CASE WHEN p0 = r0 AND p1 = r1 THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM multi""")
def accuracy_multilabel(spark, folder):
    return _round(M.accuracy(multi_label(spark, folder), "p", "r"), "accuracy")


# --- regression scores ------------------------------------------------------


def _summed(term) -> Column:
    """A number that every part of the vector goes into."""
    return F.aggregate("embedding", F.lit(0.0), lambda total, v: total + term(v.cast("double")))


_X = "list_sum([v::DOUBLE FOR v IN embedding])"
_Y = "list_sum([v::DOUBLE * abs(v::DOUBLE) FOR v IN embedding])"


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", "label", (1 + F.col("vec_id") % 4).cast("double").alias("w"),
        F.slice("embedding", 1, 32).alias("p"), F.slice("embedding", 33, 32).alias("r"),
        _summed(lambda v: v).alias("x"), _summed(lambda v: v * F.abs(v)).alias("y"),
    )


_GAPS = """
gaps AS (
  SELECT vec_id, label, CAST(1 + vec_id % 4 AS DOUBLE) AS w, o,
    pow(embedding[o + 1]::DOUBLE - embedding[o + 33]::DOUBLE, 2) AS e
  FROM embeddings, (SELECT unnest(range(32)) AS o)),
outputs AS (SELECT o, avg(e) AS mse, sum(w * e) / sum(w) AS weighted FROM gaps GROUP BY o)
"""


@query("mse_scalar", f"""
    SELECT round(avg(pow({_X} - {_Y}, 2)), 8) AS mse FROM embeddings""")
def mse_scalar(spark, folder):
    return _round(M.mse(vectors(spark, folder), "x", "y"), "mse")


@query("rmse_scalar", f"""
    SELECT round(sqrt(avg(pow({_X} - {_Y}, 2))), 8) AS mse FROM embeddings""")
def rmse_scalar(spark, folder):
    return _round(M.mse(vectors(spark, folder), "x", "y", squared=False), "mse")


@query("mse_outputs", ctes(_GAPS) + "SELECT CAST(o AS INTEGER) AS output, round(mse, 8) AS mse FROM outputs")
def mse_outputs(spark, folder):
    return _round(M.mse(vectors(spark, folder), "p", "r", multioutput="raw_values"), "mse")


@query("mse_uniform_weighted_rows", ctes(_GAPS) + "SELECT round(avg(weighted), 8) AS mse FROM outputs")
def mse_uniform_weighted_rows(spark, folder):
    return _round(M.mse(vectors(spark, folder), "p", "r", weight="w"), "mse")


@query("rmse_weighted_outputs", ctes(_GAPS) + """
    SELECT round(sum((o + 1) * sqrt(mse)) / sum(o + 1), 8) AS mse FROM outputs""")
def rmse_weighted_outputs(spark, folder):
    rows = vectors(spark, folder)
    return _round(M.mse(rows, "p", "r", multioutput=[float(o) for o in range(1, 33)], squared=False), "mse")


@query("pearson", f"""
    SELECT label, round(corr({_X}, {_Y}), 8) AS pearsonr FROM embeddings GROUP BY label""")
def pearson(spark, folder):
    return _round(M.pearson(vectors(spark, folder), "x", "y", by=("label",)), "pearsonr")


# The incomplete beta function by its continued fraction, with the sides swapped where it converges faster.
@query("pearson_pvalue", f"""
    WITH r AS (SELECT label, corr({_X}, {_Y}) AS r, count(*) AS n FROM embeddings GROUP BY label),
    sides AS (SELECT *, n / 2.0::DOUBLE - 1 AS a, 1 - r * r AS x, 1 - r * r > (n / 2.0::DOUBLE) / (n / 2.0::DOUBLE + 1.5) AS far FROM r),
    given AS (SELECT label, r, n, far, CASE WHEN far THEN 0.5::DOUBLE ELSE a END AS a, CASE WHEN far THEN a ELSE 0.5::DOUBLE END AS b, CASE WHEN far THEN 1 - x ELSE x END AS x FROM sides),
    folded AS (
      SELECT *, list_reduce(list_concat([{{'i': -1::BIGINT, 'f': 1.0::DOUBLE, 'c': 1.0::DOUBLE, 'd': 0.0::DOUBLE}}], [{{'i': k::BIGINT, 'f': 0.0::DOUBLE, 'c': 0.0::DOUBLE, 'd': 0.0::DOUBLE}} FOR k IN range(300)]),
        lambda s, q: list_transform([CASE WHEN q.i = 0 THEN 1.0::DOUBLE
            WHEN q.i % 2 = 0 THEN (q.i // 2) * (b - q.i // 2) * x / ((a + q.i - 1) * (a + q.i))
            ELSE -(a + q.i // 2) * (a + b + q.i // 2) * x / ((a + q.i - 1) * (a + q.i)) END],
          lambda t: {{'i': q.i, 'f': s.f * (1 + t / s.c) / (1 + t * s.d), 'c': 1 + t / s.c, 'd': 1 / (1 + t * s.d)}})[1]) AS cf
      FROM given),
    tails AS (SELECT *, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) / a * (cf.f - 1) AS tail FROM folded)
    SELECT label, round(r, 8) AS pearsonr, round(CASE WHEN far THEN 1 - tail ELSE tail END, 8) AS p_value FROM tails""")
def pearson_pvalue(spark, folder):
    """With the tail of the t distribution."""
    return _round(M.pearson(vectors(spark, folder), "x", "y", pvalue=True, by=("label",)), "pearsonr", "p_value")


# --- entity chunks ----------------------------------------------------------


def _chunks_sql(side: str) -> str:
    return f"""
{side}_marks AS (
  SELECT doc_id, i, substr({side}, 3) AS type, {side} <> 'O' AND (
      {side}[1] = 'B' OR lag({side}, 1, 'O') OVER w = 'O' OR substr(lag({side}, 1, 'O') OVER w, 3) <> substr({side}, 3)) AS opens,
    {side} = 'O' AS outside FROM tagged WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{side}_runs AS (
  SELECT *, sum(CASE WHEN opens OR outside THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM {side}_marks),
{side}_chunks AS (
  SELECT doc_id, min(i) || '|' || max(i) || '|' || min(type) AS chunk, min(type) AS type
  FROM {side}_runs WHERE NOT outside GROUP BY doc_id, run)
"""


_CHUNKS = (TAGGED, _chunks_sql("ref"), _chunks_sql("pred"))
_MATCHES = """
matches AS (
  SELECT coalesce(p.doc_id, r.doc_id) AS doc_id, coalesce(p.chunk, r.chunk) AS chunk, coalesce(p.type, r.type) AS type,
    CASE WHEN p.chunk IS NULL THEN 0 ELSE 1 END AS in_pred, CASE WHEN r.chunk IS NULL THEN 0 ELSE 1 END AS in_ref
  FROM pred_chunks p FULL JOIN ref_chunks r ON p.doc_id = r.doc_id AND p.chunk = r.chunk)
"""


@query("tag_chunks", ctes(*_CHUNKS) + "SELECT doc_id, chunk FROM ref_chunks")
def tag_chunks(spark, folder):
    rows = C.with_chunks(tagged(spark, folder), "ref", "chunks")
    return rows.select("doc_id", F.explode_outer("chunks").alias("chunk")).where("chunk is not null")


@query("chunk_matches", ctes(*_CHUNKS, _MATCHES) + "SELECT doc_id, chunk, in_pred, in_ref FROM matches")
def chunk_matches(spark, folder):
    return C.chunk_matches(tagged(spark, folder), "doc_id", "pred", "ref")


_ENTITY = """
sums AS (
  SELECT coalesce(type, 'overall') AS type, sum(in_pred * in_ref)::DOUBLE AS tp, sum(in_pred) AS np, sum(in_ref) AS nr
  FROM matches GROUP BY ROLLUP (type))
"""


@query("entity_scores", ctes(*_CHUNKS, _MATCHES, _ENTITY) + """
    SELECT type, round(tp / np, 8) AS precision, round(tp / nr, 8) AS recall, round(2 * tp / (np + nr), 8) AS f1,
      CAST(nr AS BIGINT) AS number FROM sums""")
def entity_scores(spark, folder):
    scores = C.entity_scores(tagged(spark, folder), "pred", "ref")
    return _round(scores, "precision", "recall", "f1")


@query("entity_scores_flat", ctes(*_CHUNKS, _MATCHES, _ENTITY) + """
    SELECT type || '_precision' AS metric, round(tp / np, 8) AS value FROM sums
    UNION ALL SELECT type || '_recall', round(tp / nr, 8) FROM sums
    UNION ALL SELECT type || '_f1', round(2 * tp / (np + nr), 8) FROM sums
    UNION ALL SELECT type || '_number', nr::DOUBLE FROM sums WHERE type <> 'overall'""")
def entity_scores_flat(spark, folder):
    return _round(C.flat_scores(C.entity_scores(tagged(spark, folder), "pred", "ref")), "value")


_ACCURACY = "round((SELECT avg(CASE WHEN pred = ref THEN 1.0::DOUBLE ELSE 0 END) FROM tagged), 8)"


@query("entity_report", ctes(*_CHUNKS, _MATCHES, _ENTITY) + f"""
    SELECT type || '_precision' AS metric, round(tp / np, 8) AS value FROM sums
    UNION ALL SELECT type || '_recall', round(tp / nr, 8) FROM sums
    UNION ALL SELECT type || '_f1', round(2 * tp / (np + nr), 8) FROM sums
    UNION ALL SELECT type || '_number', nr::DOUBLE FROM sums WHERE type <> 'overall'
    UNION ALL SELECT 'overall_accuracy', {_ACCURACY}""")
def entity_report(spark, folder):
    """Scores of every type with the accuracy over all tags."""
    rows = tagged(spark, folder)
    return _round(C.flat_scores(C.entity_scores(rows, "pred", "ref"), C.tag_accuracy(rows, "pred", "ref")), "value")


@query("entity_report_overall", ctes(*_CHUNKS, _MATCHES, _ENTITY) + f"""
    SELECT 'precision' AS metric, round(tp / np, 8) AS value FROM sums WHERE type = 'overall'
    UNION ALL SELECT 'recall', round(tp / nr, 8) FROM sums WHERE type = 'overall'
    UNION ALL SELECT 'f1', round(2 * tp / (np + nr), 8) FROM sums WHERE type = 'overall'
    UNION ALL SELECT 'accuracy', {_ACCURACY}""")
def entity_report_overall(spark, folder):
    """The four values over all types."""
    rows = tagged(spark, folder)
    return _round(C.overall_scores(C.entity_scores(rows, "pred", "ref"), C.tag_accuracy(rows, "pred", "ref")), "value")


@query("entity_scores_none", ctes(TAGGED) + """
    SELECT 'overall' AS type, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1,
      CAST(count(*) FILTER (WHERE replace(pred, pred, 'O') <> 'O') AS BIGINT) AS number FROM tagged""")
def entity_scores_none(spark, folder):
    """No entity on either side still gives an overall row."""
    rows = tagged(spark, folder)
    outside = {c: F.transform(c, lambda t: F.lit("O")) for c in ("pred", "ref")}
    return C.entity_scores(rows.withColumns(outside), "pred", "ref")


# A strict chunk opens at a begin tag only and lasts while inside tags of its type follow.
_STRICT = """
{side}_steps AS (
  SELECT doc_id, i, {side} AS tag, {side}[1] = 'B' AS opens, {side}[1] = 'I' AND lag({side}, 1, 'O') OVER w <> 'O'
    AND substr(lag({side}, 1, 'O') OVER w, 3) = substr({side}, 3) AS goes_on
  FROM tagged WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{side}_chunks AS (
  SELECT doc_id, min(i) || '|' || max(i) || '|' || min(substr(tag, 3)) AS chunk, min(substr(tag, 3)) AS type FROM (
    SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM {side}_steps)
  GROUP BY doc_id, run HAVING bool_or(opens))
"""


@query(
    "entity_scores_strict",
    ctes(TAGGED, _STRICT.replace("{side}", "ref"), _STRICT.replace("{side}", "pred"), _MATCHES, _ENTITY) + """
    SELECT type, round(tp / np, 8) AS precision, round(tp / nr, 8) AS recall, round(2 * tp / (np + nr), 8) AS f1,
      CAST(nr AS BIGINT) AS number FROM sums""",
)
def entity_scores_strict(spark, folder):
    scores = C.entity_scores(tagged(spark, folder), "pred", "ref", scheme="IOB2", mode="strict")
    return _round(scores, "precision", "recall", "f1")


@query("tag_accuracy", ctes(TAGGED) + """
    SELECT round(avg(CASE WHEN pred = ref THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy FROM tagged""")
def tag_accuracy(spark, folder):
    return _round(C.tag_accuracy(tagged(spark, folder), "pred", "ref"), "accuracy")


# --- losses and masked tokens -----------------------------------------------


@query("perplexity", "SELECT event_type AS run, round(exp(avg(value / 100)), 6) AS perplexity FROM events GROUP BY 1")
def perplexity(spark, folder):
    losses = table(spark, folder, "events").select(F.col("event_type").alias("run"), (F.col("value") / 100).alias("loss"))
    return M.perplexity(losses, "loss", by=("run",)).withColumn("perplexity", F.round("perplexity", 6))


@query("mean_loss", """
    SELECT event_type AS run, event_id // 1000 AS epoch, round(avg(value), 6) AS train_loss, count(value) AS steps
    FROM events GROUP BY ALL""")
def mean_loss(spark, folder):
    log = table(spark, folder, "events").select(
        F.col("event_type").alias("run"), F.expr("event_id div 1000").alias("epoch"), F.col("value").alias("loss")
    )
    return M.mean_loss(log, "loss").withColumn("train_loss", F.round("train_loss", 6))


@query("masked_token_accuracy", """
    WITH t AS (
      SELECT length(w) AS r, CASE WHEN (i + doc_id) % 3 = 0 THEN length(w) ELSE 1 END AS p, (i + doc_id) % 7 = 0 AS seen
      FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w,
        generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM documents))
    SELECT round(avg(CASE WHEN p = r THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy, count(*) AS positions FROM t WHERE seen""")
def masked_token_accuracy(spark, folder):
    """Predictions against labels at the positions that were masked."""
    words, doc = F.split("text", " "), F.col("doc_id")
    rows = documents(spark, folder).select(
        F.transform(words, lambda w, i: F.when((i + doc) % 7 == 0, F.length(w)).otherwise(-100)).alias("labels"),
        F.transform(words, lambda w, i: F.when((i + doc) % 3 == 0, F.length(w)).otherwise(1)).alias("p"),
    )
    return _round(M.visible_accuracy(rows, "p", "labels"), "accuracy")


@query("combined_score", """
    SELECT event_type || '-' || user_id AS run, round(avg(value), 6) AS combined_score FROM events
    GROUP BY 1 HAVING count(*) > 1""")
def combined_score(spark, folder):
    records = table(spark, folder, "events").select(
        F.concat_ws("-", "event_type", "user_id").alias("run"), F.col("event_id").cast("string").alias("metric"), "value"
    )
    return M.combined_score(records, ("run",)).withColumn("combined_score", F.round("combined_score", 6))


# --- regression on vectors --------------------------------------------------


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.slice("embedding", 2, 63).alias("v"),
        (F.col("label").cast("double") + F.col("embedding")[0]).alias("similarity"),
    )
    return G.as_features(rows, "v", "similarity", "vec_id", folds=FOLDS)


FOLDS, SHARDS, EPOCHS = 3, 4, 3


def _draw_sql(purpose: str, values: int) -> str:
    return f"CAST(('0x' || substr(md5(vec_id || '|{purpose}|42'), 1, 8)) AS BIGINT) % {values}"


_FEATURES = f"""
features AS (
  SELECT vec_id, CAST(embedding[2:64] AS DOUBLE[]) AS x, CAST(label AS DOUBLE) + CAST(embedding[1] AS DOUBLE) AS y, {_draw_sql("fold", FOLDS)} AS fold,
    {_draw_sql("shard", SHARDS)} AS shard, md5(vec_id || '|order|42') AS at FROM embeddings)
"""


def _descent_sql(models: str, rows: str) -> str:
    """Epochs of descent, a CTE each: every shard folds its rows into the weights, which are averaged."""
    parts = [f"""
models AS (SELECT * FROM (VALUES {models}) t(alpha, eta0, without)),
used AS (SELECT * FROM features WHERE {rows}),
steps AS (SELECT shard, count(*) AS n FROM used GROUP BY shard),
epoch0 AS (SELECT alpha, eta0, without, [0.0::DOUBLE FOR i IN range(63)] AS w, 0.0::DOUBLE AS b FROM models)"""]
    for k in range(EPOCHS):
        parts.append(f"""
lists{k} AS (
  SELECT m.alpha, m.eta0, m.without, u.shard, count(*) FILTER (WHERE fold <> without) AS n,
    list_concat([{{'x': []::DOUBLE[], 'y': 0.0::DOUBLE, 'f': -1::BIGINT, 'w': any_value(m.w), 'b': any_value(m.b), 't': {k} * any_value(s.n)}}],
      list({{'x': u.x, 'y': u.y, 'f': u.fold, 'w': []::DOUBLE[], 'b': 0.0::DOUBLE, 't': 0::BIGINT}} ORDER BY u.at, u.vec_id)) AS rows
  FROM epoch{k} m, used u JOIN steps s ON s.shard = u.shard GROUP BY m.alpha, m.eta0, m.without, u.shard),
shards{k} AS (
  SELECT alpha, eta0, without, shard, n, list_reduce(rows, lambda s, r: CASE WHEN r.f = without
      THEN {{'x': []::DOUBLE[], 'y': 0.0::DOUBLE, 'f': -1::BIGINT, 'w': s.w, 'b': s.b, 't': s.t + 1}}
      ELSE list_transform([{{'eta': eta0 / (s.t + 1) ** 0.25, 'e': list_dot_product(s.w, r.x) + s.b - r.y}}], lambda g: {{'x': []::DOUBLE[], 'y': 0.0::DOUBLE, 'f': -1::BIGINT,
        'w': list_transform(list_zip(s.w, r.x), lambda z: z[1] * greatest(1 - g.eta * alpha, 0) - g.eta * g.e * z[2]), 'b': s.b - g.eta * g.e, 't': s.t + 1}})[1] END) AS last
  FROM lists{k}),
epoch{k + 1} AS (
  SELECT alpha, eta0, without, list(w ORDER BY i) AS w, any_value(b) AS b FROM (
    SELECT alpha, eta0, without, i, sum(n * last.w[i]) / sum(n) AS w, sum(n * last.b) / sum(n) AS b
    FROM shards{k}, range(1, 64) r(i) GROUP BY alpha, eta0, without, i) GROUP BY alpha, eta0, without)""")
    return ",".join(parts)


@query("similarity_regression", "WITH " + _FEATURES + "," + _descent_sql("(0.0001::DOUBLE, 0.01::DOUBLE, -1)", "vec_id % 5 <> 0") + f"""
    SELECT count(*) AS n, round(corr(p, y), 6) AS pearsonr, round(avg((p - y) ** 2), 6) AS mse FROM (
      SELECT list_dot_product(m.w, f.x) + m.b AS p, y FROM features f, epoch{EPOCHS} m WHERE vec_id % 5 = 0)""")
def similarity_regression(spark, folder):
    """Descend on four fifths of the vectors, predict the rest, correlate."""
    rows = _pairs(spark, folder)
    [model] = G.descend(rows.where("vec_id % 5 <> 0"), [G.Descent(1e-4, 1e-2)], key="vec_id", max_iter=EPOCHS, tol=None, shards=SHARDS)
    test = G.predicted(rows.where("vec_id % 5 = 0"), model.weights, model.intercept)
    mse = F.avg(F.pow(F.col("prediction") - F.col("y"), 2.0))
    return test.agg(F.count("*").alias("n"), F.round(F.corr("prediction", "y"), 6).alias("pearsonr"), F.round(mse, 6).alias("mse"))


ALPHAS, RATES = (1e-4, 1e-1), (1e-3, 1e-2)
_GRID = ", ".join(f"({a}::DOUBLE, {e}::DOUBLE, {f})" for a in ALPHAS for e in RATES for f in range(FOLDS))


@query("similarity_grid_search", "WITH " + _FEATURES + "," + _descent_sql(_GRID, "true") + f""",
    scores AS (
      SELECT alpha, eta0, avg(mse) AS mse FROM (
        SELECT m.alpha, m.eta0, m.without, avg((list_dot_product(m.w, f.x) + m.b - y) ** 2) AS mse
        FROM epoch{EPOCHS} m JOIN features f ON f.fold = m.without GROUP BY ALL) GROUP BY ALL)
    SELECT alpha, eta0, round(mse, 6) AS mse, mse = min(mse) OVER () AS best FROM scores""")
def similarity_grid_search(spark, folder):
    """Cross-validated penalties and rates with their error; all learn in the same passes."""
    scores, _ = G.grid_search(
        _pairs(spark, folder), key="vec_id", alphas=list(ALPHAS), eta0s=list(RATES), folds=FOLDS, max_iter=EPOCHS, tol=None, shards=SHARDS, refit=False
    )
    best = min(score for *_, score in scores)
    return spark.createDataFrame([(a, e, round(m, 6), m == best) for a, e, m in scores], "alpha double, eta0 double, mse double, best boolean")


@query("ridge_normal_equations", "WITH " + _FEATURES + f""",
    entries AS (SELECT fold, y, unnest(range(1, 65)) AS i, list_append(x, 1.0::DOUBLE) AS z FROM features),
    cross_sums AS (SELECT g.without, e.i, sum(e.z[e.i] * e.y) AS c FROM entries e JOIN range({FOLDS}) g(without) ON e.fold <> g.without GROUP BY ALL)
    SELECT a.alpha, CAST(without AS INTEGER) AS without, CAST(i AS INTEGER) AS i, round(c, 3) AS cross FROM cross_sums, (VALUES (0.0001::DOUBLE), (0.01::DOUBLE), (1.0::DOUBLE)) a(alpha)""")
def ridge_normal_equations(spark, folder):
    """Ridge weights of every penalty without each fold, from one aggregate: put back into the equations
    they solve, they give the sums of the data."""
    moments = G.fold_moments(_pairs(spark, folder), 63)
    rows = []
    for alpha in (1e-4, 1e-2, 1.0):
        for fold, own in moments.items():
            rest = sum([m for f, m in moments.items() if f != fold][1:], start=[m for f, m in moments.items() if f != fold][0])
            w = rest.ridge(alpha)
            left = rest.gram @ w + alpha * rest.n * (w * ([1.0] * 63 + [0.0]))
            rows += [(alpha, fold, i + 1, round(float(v), 3)) for i, v in enumerate(left)]
    return spark.createDataFrame(rows, "alpha double, without int, i int, cross double")
