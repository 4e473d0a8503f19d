"""Queries over task data: labels, splits, relations, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import arrays as AR
from ..functions.text import join_text
from ..operators import labels as L, predictions as P, relations as R
from ..session import new_path
from ..sources import records as RS, tasks as TS
from .registry import ctes, query
from .tables import TAGS, documents, table, tag_at

# --- relations --------------------------------------------------------------


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with two entities at a third and two thirds of the text, and
    relations between them in both directions; short texts make them overlap."""
    doc, n = F.col("doc_id"), F.length("text").cast("int")
    s1, s2 = F.expr("cast(length(text) div 3 as int)"), F.expr("cast(2 * length(text) div 3 as int)")

    def entity(name: str, kind, start, size: int):
        return F.struct(
            F.lit(name).alias("id"), kind.alias("type"),
            F.array(F.array(start, F.least(start + size, n))).alias("offsets"),
        )

    def relation(name: str, kind, a: str, b: str):
        return F.struct(
            F.lit(name).alias("id"), kind.alias("type"), F.lit(a).alias("arg1_id"), F.lit(b).alias("arg2_id")
        )

    first = F.when(doc % 2 == 0, "CHEMICAL").otherwise("GENE")
    kind = F.concat(F.lit("CPR:"), (doc % 5).cast("string"))
    return documents(spark, folder).select(
        F.concat(F.lit("d"), doc.cast("string")).alias("document_id"),
        F.array(F.struct(F.array("text").alias("text"))).alias("passages"),
        F.array(
            entity("T1", first, s1, 7), entity("T2", F.lit("DRUG"), s2, 5), entity("T2", F.lit("LATER"), s1, 1)
        ).alias("entities"),
        F.array(relation("R1", kind, "T1", "T2"), relation("R2", F.lit("NOT"), "T2", "T1")).alias("relations"),
        (doc % 3).alias("fold"),
    )


_ANNOTATED = """
annotated AS (
  SELECT 'd' || doc_id AS document_id, text, length(text) AS n,
    length(text) // 3 AS s1, least(length(text) // 3 + 7, length(text)) AS e1,
    2 * length(text) // 3 AS s2, least(2 * length(text) // 3 + 5, length(text)) AS e2,
    CASE WHEN doc_id % 2 = 0 THEN 'CHEMICAL' ELSE 'GENE' END AS t1, 'CPR:' || (doc_id % 5) AS kind
  FROM documents),
relations AS (
  SELECT document_id || '_R1' AS id, kind AS label, text, n, s1 AS sa, e1 AS ea, t1 AS ta, s2 AS sb, e2 AS eb, 'DRUG' AS tb FROM annotated
  UNION ALL
  SELECT document_id || '_R2', 'NOT', text, n, s2, e2, 'DRUG', s1, e1, t1 FROM annotated)
"""


@query("relation_arguments", ctes(_ANNOTATED) + """
    SELECT id, label, ta AS type1, sa AS start1, tb AS type2, sb AS start2 FROM relations""")
def relation_arguments(spark, folder):
    return R.relation_arguments(annotated(spark, folder)).select(
        F.concat_ws("_", "document_id", "relation.id").alias("id"),
        F.col("relation.type").alias("label"),
        F.col("e1.type").alias("type1"), F.col("e1.offsets")[0][0].alias("start1"),
        F.col("e2.type").alias("type2"), F.col("e2.offsets")[0][0].alias("start2"),
    )


def _sentences_sql(last: str) -> str:
    mark = "translate({}, '!?', '..')"
    back = mark.format("reverse(substr(text, 2, least(sa, sb)))")
    ahead = mark.format("substr(text, greatest(ea, eb) + 1)")
    return ctes(_ANNOTATED) + f""",
    cut AS (
      SELECT *, CASE WHEN strpos({back}, '.') > 0 THEN least(sa, sb) - strpos({back}, '.') + 2 ELSE 0 END AS b,
        CASE WHEN strpos({ahead}, '.') > 0 THEN greatest(ea, eb) + strpos({ahead}, '.') - 1 ELSE {last} END AS f,
        least(sa, sb) AS ls, CASE WHEN sa < sb THEN ea ELSE eb END AS le, CASE WHEN sa < sb THEN ta ELSE tb END AS lt,
        CASE WHEN sa < sb THEN sb ELSE sa END AS rs, CASE WHEN sa < sb THEN eb ELSE ea END AS re,
        CASE WHEN sa < sb THEN tb ELSE ta END AS rt
      FROM relations)
    SELECT id, label, substr(text, b + 1, greatest(ls - b, 0)) || '@' || lt || '$' ||
      substr(text, le + 1, greatest(rs - le, 0)) || '@' || rt || '$' || substr(text, re + 1, greatest(f - re, 0)) AS text
    FROM cut"""


@query("masked_sentences", _sentences_sql("n - 1"))
def masked_sentences(spark, folder):
    return R.masked_sentences(annotated(spark, folder))


@query("masked_sentences_whole", _sentences_sql("n"))
def masked_sentences_whole(spark, folder):
    """With the last character kept where no sentence mark follows."""
    return R.masked_sentences(annotated(spark, folder), keep_last=True)


@query("task_tables", """
    SELECT 'd' || doc_id AS document_id, ['chemprot', 'ddi_corpus', 'gad'][CAST(doc_id % 3 AS INTEGER) + 1] AS dataset,
      'relation_extraction' AS task FROM documents WHERE doc_id % 2 = 1""")
def task_tables(spark, folder):
    """Annotated documents stored by task and dataset, one task read back."""
    path = new_path(spark, "tasks")
    number = F.substring("document_id", 2, 20).cast("long")
    names = F.array(*[F.lit(d) for d in TS.TASK_DATASETS["relation_extraction"]])
    rows = annotated(spark, folder).select(
        "document_id", "passages", "entities", "relations",
        F.when(number % 2 == 1, "relation_extraction").otherwise("ner").alias("task"),
        F.when(number % 2 == 1, F.get(names, F.col("fold").cast("int"))).otherwise("bc2gm").alias("dataset"),
    )
    TS.write_tasks(rows, path)
    return TS.scan_tasks(spark, path, "relation_extraction").select("document_id", "dataset", "task")


# --- labels -----------------------------------------------------------------

_SPLIT = "CASE WHEN vec_id % 10 < 7 THEN 'train' WHEN vec_id % 10 < 9 THEN 'validation' ELSE 'test' END"
_LABELLED = f"""
labelled AS (
  SELECT vec_id, {_SPLIT} AS split,
    CASE WHEN vec_id % 13 = 0 THEN '-1' WHEN {_SPLIT} = 'train' AND label >= 8 THEN 'c0' ELSE 'c' || label END AS label
  FROM embeddings)
"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with split and label; two labels are unknown to the training split."""
    tenth = F.col("vec_id") % 10
    split = F.when(tenth < 7, "train").when(tenth < 9, "validation").otherwise("test")
    name = F.concat(F.lit("c"), F.col("label").cast("string"))
    label = F.when(F.col("vec_id") % 13 == 0, "-1").when((tenth < 7) & (F.col("label") >= 8), "c0").otherwise(name)
    return table(spark, folder, "embeddings").select("vec_id", split.alias("split"), label.alias("label"))


_VOCABULARY = """
names AS (
  SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
  FROM (SELECT DISTINCT label FROM labelled WHERE label <> '-1'))
"""


@query("label_vocabulary", ctes(_LABELLED, _VOCABULARY) + "SELECT label, label_id FROM names")
def label_vocabulary(spark, folder):
    """Labels of all splits without the unlabelled marker, numbered in sorted order."""
    return L.labels_of_splits(labelled(spark, folder), "label", check=True)


@query("label_vocabulary_of_lists", """
    SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id
    FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS label FROM part)""")
def label_vocabulary_of_lists(spark, folder):
    rows = table(spark, folder, "part").select(F.split("p_name", " ").alias("tags"))
    return L.label_vocabulary(L.distinct_labels(rows, "tags"))


@query("labels_missing_from_train", ctes(_LABELLED) + """
    SELECT DISTINCT label FROM labelled WHERE split = 'test'
    EXCEPT SELECT label FROM labelled WHERE split = 'train'""")
def labels_missing_from_train(spark, folder):
    return L.labels_missing_from(labelled(spark, folder), "label", "test")


@query("encoded_labels", ctes(_LABELLED, _VOCABULARY) + """
    SELECT l.vec_id, l.split, l.label, CASE WHEN l.label = '-1' THEN -1 ELSE n.label_id END AS label_id
    FROM labelled l LEFT JOIN names n ON n.label = l.label""")
def encoded_labels(spark, folder):
    rows = labelled(spark, folder)
    return L.encode_label(rows, "label", L.labels_of_splits(rows, "label"))


@query("decoded_labels", ctes(_LABELLED, _VOCABULARY) + """
    SELECT e.vec_id, n.label FROM embeddings e LEFT JOIN names n ON n.label_id = e.label""")
def decoded_labels(spark, folder):
    vocabulary = L.labels_of_splits(labelled(spark, folder), "label")
    ids = table(spark, folder, "embeddings").select("vec_id", F.col("label").alias("prediction"))
    return L.decode_label(ids, "prediction", vocabulary).select("vec_id", "label")


@query("merged_splits", ctes(_LABELLED) + """
    SELECT vec_id, label, CASE WHEN split = 'validation' THEN 'train' ELSE split END AS split FROM labelled""")
def merged_splits(spark, folder):
    return L.merge_splits(labelled(spark, folder), "validation", "train")


_TAG_NAMES = """
tag_names AS (
  SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id FROM (
    SELECT DISTINCT ['B-', 'I-', 'B-', 'O'][CAST(p_partkey % 4 AS INTEGER) + 1] ||
      CASE WHEN p_partkey % 4 = 3 THEN '' WHEN p_partkey % 4 = 1 THEN p_type ELSE p_brand END AS label FROM part
    UNION SELECT DISTINCT 'B-' || p_type FROM part))
"""


@query("inside_label_ids", ctes(_TAG_NAMES) + """
    SELECT b.label, b.label_id, coalesce(i.label_id, b.label_id) AS inside_id FROM tag_names b
    LEFT JOIN tag_names i ON b.label LIKE 'B-%' AND i.label = replace(b.label, 'B-', 'I-')""")
def inside_label_ids(spark, folder):
    """Begin labels with and without an inside twin."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey") % 4
    prefix = F.when(key == 1, "I-").when(key == 3, "O").otherwise("B-")
    tail = F.when(key == 3, "").when(key == 1, F.col("p_type")).otherwise(F.col("p_brand"))
    tags = part.select(F.concat(prefix, tail).alias("label")).unionByName(
        part.select(F.concat(F.lit("B-"), "p_type").alias("label"))
    )
    return L.inside_ids(L.label_vocabulary(tags))


# --- word pieces and labels -------------------------------------------------


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Words cut into pieces of four characters, with the word of each piece,
    and a tag id per word."""
    names = F.array(*[F.lit(t) for t in TAGS])
    words = F.split("text", " ")
    pieces = F.transform(words, lambda w: F.greatest(F.ceil(F.length(w) / 4).cast("int"), F.lit(1)))
    owners = F.flatten(F.transform(pieces, lambda n, i: F.array_repeat(i, n)))
    special = F.array(F.lit(None).cast("int"))
    tags = F.transform(
        F.sequence(F.lit(0), F.size(words) - 1),
        lambda i: (F.array_position(names, tag_at(i, F.col("doc_id"))) - 1).cast("int"),
    )
    return documents(spark, folder).select(
        "doc_id", F.concat(special, owners, special).alias("word_ids"), tags.alias("tags")
    )


def _aligned_sql(later: str) -> str:
    slot = "(i + doc_id) % 11"
    return f"""
    WITH words AS (
      SELECT doc_id, i, CASE WHEN {slot} IN (0, 6) THEN 0 WHEN {slot} = 4 THEN 1 WHEN {slot} IN (1, 2) THEN 2
          WHEN {slot} IN (5, 9) THEN 3 ELSE 4 END AS tag,
        greatest(CAST(ceil(length(w) / 4.0) AS INTEGER), 1) AS n
      FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w,
        generate_subscripts(string_split(text, ' '), 1) - 1 AS i FROM documents)),
    later AS (SELECT *, {later} AS rest FROM words)
    SELECT doc_id, '-100 ' || string_agg(tag || repeat(' ' || rest, n - 1), ' ' ORDER BY i) || ' -100' AS labels
    FROM later GROUP BY doc_id"""


@query("aligned_first_pieces", _aligned_sql("-100"))
def aligned_first_pieces(spark, folder):
    rows = _pieces(spark, folder)
    labels = AR.aligned_labels(F.col("word_ids"), F.col("tags"))
    return rows.select("doc_id", F.array_join(labels.cast("array<string>"), " ").alias("labels"))


@query("aligned_all_pieces", _aligned_sql("CASE tag WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE tag END"))
def aligned_all_pieces(spark, folder):
    """Later pieces of a word take the inside label."""
    inside = F.array(*[F.lit(TAGS.index(t.replace("B-", "I-"))) for t in TAGS])
    rows = _pieces(spark, folder)
    labels = AR.aligned_labels(F.col("word_ids"), F.col("tags"), inside)
    return rows.select("doc_id", F.array_join(labels.cast("array<string>"), " ").alias("labels"))


@query("multi_hot_labels", """
    SELECT doc_id, CAST(quality AS DOUBLE) AS quality, CAST(toxic AS DOUBLE) AS toxic,
      CAST(quality + toxic AS DOUBLE) AS total FROM labels""")
def multi_hot_labels(spark, folder):
    """Label ids of a row as a 0/1 vector."""
    rows = table(spark, folder, "labels")
    ids = F.filter(
        F.array(F.when(F.col("quality") == 1, 0), F.when(F.col("toxic") == 1, 1)), lambda x: x.isNotNull()
    )
    hot = rows.select("doc_id", AR.multi_hot(ids, 2).alias("v"))
    return hot.select(
        "doc_id", F.col("v")[0].alias("quality"), F.col("v")[1].alias("toxic"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
    )


@query("first_answer", """
    SELECT conv_id, turn, TRY_CAST(string_split(text, ' ')[1] AS INTEGER) AS answer,
      string_split(text, ' ')[1] AS raw FROM conversations""")
def first_answer(spark, folder):
    rows = table(spark, folder, "conversations").withColumn("answers", F.split("text", " "))
    return rows.select(
        "conv_id", "turn", AR.first_as_int(F.col("answers")).alias("answer"),
        F.get("answers", F.lit(0)).alias("raw"),
    )


@query("first_label_as_int", """
    SELECT doc_id, quality AS label FROM labels""")
def first_label_as_int(spark, folder):
    """Single-element label lists as a renamed int column."""
    rows = table(spark, folder, "labels").select("doc_id", F.array(F.col("quality").cast("string")).alias("labels"))
    return rows.withColumn("labels", AR.first_as_int(F.col("labels"))).withColumnRenamed("labels", "label")


@query("joined_text", """
    SELECT q.conv_id, q.turn, q.text || '[SEP]' || a.text AS sentence FROM conversations q
    JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1""")
def joined_text(spark, folder):
    """Question and context in one text column."""
    rows = table(spark, folder, "conversations")
    context = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context"))
    pairs = rows.withColumnRenamed("text", "question").join(context, ["conv_id", "turn"])
    return pairs.select(
        "conv_id", "turn", join_text(F.col("question"), F.col("context"), delimiter="[SEP]").alias("sentence")
    )


@query("task_columns", "SELECT doc_id AS id, text, source AS label FROM documents")
def task_columns(spark, folder):
    """Columns of a task table dropped and the label column renamed."""
    return (
        documents(spark, folder).drop("lang", "n_chars")
        .withColumnsRenamed({"source": "label", "doc_id": "id"})
    )


# --- predictions ------------------------------------------------------------


def logits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("index"), F.col("embedding").alias("logits"), "label", "embedding"
    )


_LOGITS = "logits AS (SELECT vec_id AS index, embedding AS l, embedding, label FROM embeddings)"
_CLASS = "list_position(l, list_max(l)) - 1"


@query("predicted_class", ctes(_LOGITS) + f"""
    SELECT index, CAST({_CLASS} AS INTEGER) AS prediction FROM logits""")
def predicted_class(spark, folder):
    return P.predicted_class(logits(spark, folder), "logits").select("index", "prediction")


_NAMES = [f"label{i}" for i in range(64)]


@query("predicted_label_lists", ctes(_LOGITS) + """
    SELECT index, array_to_string(['label' || i FOR i IN range(64) IF l[i + 1] > 0], ',') AS prediction FROM logits""")
def predicted_label_lists(spark, folder):
    rows = P.predicted_labels(logits(spark, folder), "logits", _NAMES)
    return rows.select("index", F.array_join("prediction", ",").alias("prediction"))


_POSITIONS = """
positions AS (
  SELECT index, j, list_position(embedding[j * 5 + 1:j * 5 + 5], list_max(embedding[j * 5 + 1:j * 5 + 5])) AS p,
    CASE WHEN (index + j) % 4 = 0 THEN -100 ELSE (index + j) % 5 END AS l
  FROM (SELECT index, embedding, unnest(range(13)) AS j FROM logits))
"""


@query("predicted_tags", ctes(_LOGITS, _POSITIONS) + f"""
    SELECT index, string_agg({TAGS!r}[p], ' ' ORDER BY j) AS pred_tags,
      string_agg({TAGS!r}[CAST(l AS INTEGER) + 1], ' ' ORDER BY j) AS true_tags
    FROM positions WHERE l <> -100 GROUP BY index""")
def predicted_tags(spark, folder):
    """Tags per position from five logits each; ignored positions are left out."""
    rows = _token_logits(spark, folder)
    tags = P.predicted_tags(rows, "token_logits", "labels", TAGS)
    return tags.select(
        "index", F.array_join("pred_tags", " ").alias("pred_tags"), F.array_join("true_tags", " ").alias("true_tags")
    )


def _token_logits(spark: SparkSession, folder: str) -> DataFrame:
    tokens = F.array(*[F.slice("embedding", j * 5 + 1, 5) for j in range(13)])
    place = lambda j: F.col("index") + j
    labels = F.array(*[
        F.when(place(j) % 4 == 0, F.lit(AR.IGNORED)).otherwise((place(j) % 5).cast("int")) for j in range(13)
    ])
    return logits(spark, folder).select("index", tokens.alias("token_logits"), labels.alias("labels"))


@query("prediction_file", ctes(_LOGITS) + f"SELECT index, 'label' || ({_CLASS}) AS prediction FROM logits")
def prediction_file(spark, folder):
    """Class names per index written as tab-separated lines and read back."""
    path = new_path(spark, "predictions")
    names = F.array(*[F.lit(n) for n in _NAMES])
    rows = P.predicted_class(logits(spark, folder), "logits")
    RS.write_predictions(rows.select("index", F.get(names, F.col("prediction")).alias("prediction")), path)
    return RS.read_predictions(spark, path)


@query("prediction_list_file", ctes(_LOGITS) + """
    SELECT index, '[' || array_to_string(['''label' || i || '''' FOR i IN range(64) IF l[i + 1] > 0], ', ') || ']' AS prediction
    FROM logits""")
def prediction_list_file(spark, folder):
    path = new_path(spark, "predictions")
    RS.write_predictions(P.predicted_labels(logits(spark, folder), "logits", _NAMES).select("index", "prediction"), path)
    return RS.read_predictions(spark, path)


@query("prediction_tag_file", ctes(_LOGITS, _POSITIONS) + f"""
    SELECT string_agg({TAGS!r}[p], ' ' ORDER BY j) AS value FROM positions WHERE l <> -100 GROUP BY index""")
def prediction_tag_file(spark, folder):
    path = new_path(spark, "tags")
    RS.write_tag_lines(P.predicted_tags(_token_logits(spark, folder), "token_logits", "labels", TAGS), path)
    return spark.read.text(path)
