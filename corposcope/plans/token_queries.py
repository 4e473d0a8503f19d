"""Queries over tokens: vocabularies, ids, lengths, packing, masking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import fixed_length, truncated
from ..operators import tokens as T
from ..operators.scoring import BANDS, Band
from ..operators.token_store import pack_stored, split_stored, store_tokens
from ..operators.word_pieces import tokenise_native
from ..session import new_path, staged
from ..sources.records import scan_vocabulary
from . import jobs
from .article_queries import BAND_ROWS
from .registry import ctes, query
from .tables import ORDERED, SCORED_ALL, VOCABULARY, WORDS, documents, scored, table

PACK_LENGTH, PACK_BATCH = 128, 64


def _docs(spark, folder):
    return documents(spark, folder).select("doc_id", "text")


@query("word_vocabulary", ctes(WORDS, VOCABULARY) + "SELECT word, n, word_id FROM vocabulary")
def word_vocabulary(spark, folder):
    return T.word_vocabulary(_docs(spark, folder))


_WORD_IDS = """
word_ids AS (
  SELECT p.doc_id, list(v.word_id ORDER BY p.pos) AS ids
  FROM placed p JOIN vocabulary v ON v.word = p.word GROUP BY p.doc_id)
"""


def word_ids(spark: SparkSession, folder: str, **join) -> DataFrame:
    docs = _docs(spark, folder)
    return T.word_ids(docs, T.word_vocabulary(docs), "doc_id", **join)


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " ") for c in columns})


@query("word_token_ids", ctes(WORDS, VOCABULARY, _WORD_IDS) + """
    SELECT doc_id, array_to_string(ids, ' ') AS ids FROM word_ids""")
def word_token_ids(spark, folder):
    return _joined(word_ids(spark, folder), "ids")


@query("word_token_ids_salted", ctes(WORDS, VOCABULARY, _WORD_IDS) + """
    SELECT doc_id, array_to_string(ids, ' ') AS ids FROM word_ids""")
def word_token_ids_salted(spark, folder):
    """The join taken when the vocabulary is too large to broadcast."""
    return _joined(word_ids(spark, folder, shuffled=True), "ids")


# Words and marks of the piece vocabulary, and greedy longest match in SQL.
_SPACED = r"""regexp_replace(lower(text), '([^\p{L}\p{N}])', ' \1 ', 'g')"""
_PIECES = f"""
counted AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(string_split({_SPACED}, ' ')) AS word FROM benchmark)
  WHERE word <> '' AND regexp_full_match(word, '\\S+') GROUP BY word),
spelled AS (SELECT DISTINCT unnest(string_split({_SPACED}, ' ')) AS word FROM documents),
chars AS (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM spelled WHERE word <> '' AND regexp_full_match(word, '\\S+')),
pieces AS (
  SELECT piece, CAST(row_number() OVER (ORDER BY kind, pos, piece) - 1 AS INTEGER) AS id FROM (
    SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 0, 1), ('[CLS]', 0, 2), ('[SEP]', 0, 3), ('[MASK]', 0, 4)) t(piece, kind, pos)
    UNION ALL SELECT ch, 1, 0 FROM chars WHERE ch <> ''
    UNION ALL SELECT '##' || ch, 2, 0 FROM chars WHERE ch <> ''
    UNION ALL SELECT word, 3, -n FROM counted WHERE length(word) > 1))
"""


@query("piece_vocabulary", ctes(_PIECES) + "SELECT piece, id FROM pieces")
def piece_vocabulary(spark, folder):
    return T.piece_vocabulary(table(spark, folder, "benchmark"), _docs(spark, folder))


_vocabularies: dict[tuple[str, str], str] = {}


def vocabulary_file(spark: SparkSession, folder: str) -> str:
    """The piece table written as a file, as published ones are, once in a session."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _vocabularies:
        path = new_path(spark, "vocabulary")
        T.write_vocabulary(piece_vocabulary(spark, folder), path)
        _vocabularies[known] = path
    return _vocabularies[known]


@query("piece_vocabulary_file", ctes(_PIECES) + "SELECT piece, id FROM pieces")
def piece_vocabulary_file(spark, folder):
    """Written one piece per line and scanned again; the id is the line number."""
    return scan_vocabulary(spark, vocabulary_file(spark, folder))


_MATCHED = r"""
chunks AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\s+')) AS chunk,
    generate_subscripts(regexp_split_to_array(text, '\s+'), 1) AS pos FROM documents),
bare AS (SELECT chunk, strip_accents(lower(chunk)) AS plain FROM (SELECT DISTINCT chunk FROM chunks)),
parts AS (
  SELECT chunk, unnest(string_split(regexp_replace(plain, '([\p{P}$+<=>^`|~])', ' \1 ', 'g'), ' ')) AS word,
    generate_subscripts(string_split(regexp_replace(plain, '([\p{P}$+<=>^`|~])', ' \1 ', 'g'), ' '), 1) AS part
  FROM bare),
matched AS (
  SELECT word, 0 AS step, 0 AS pos, []::INTEGER[] AS ids FROM (SELECT DISTINCT word FROM parts WHERE word <> '')
  UNION ALL
  SELECT word, step + 1, pos + taken, list_append(ids, id) FROM (
    SELECT m.word, m.step, m.pos, m.ids, p.id, l AS taken,
      row_number() OVER (PARTITION BY m.word ORDER BY l DESC) AS rn
    FROM (SELECT *, unnest(range(1, length(word) - pos + 1)) AS l FROM matched WHERE pos < length(word)) m
    JOIN pieces p ON p.piece = CASE WHEN m.pos = 0 THEN '' ELSE '##' END || substr(m.word, m.pos + 1, l))
  WHERE rn = 1),
word_pieces AS (
  SELECT w.word, CASE WHEN m.ids IS NULL THEN [1] ELSE m.ids END AS ids
  FROM (SELECT DISTINCT word FROM parts WHERE word <> '') w
  LEFT JOIN matched m ON m.word = w.word AND m.pos = length(m.word)),
chunk_pieces AS (
  SELECT chunk, flatten(list(ids ORDER BY part)) AS ids
  FROM parts JOIN word_pieces USING (word) GROUP BY chunk),
token_ids AS (
  SELECT c.doc_id, list_concat(list_concat([2], flatten(list(p.ids ORDER BY c.pos))), [3]) AS ids
  FROM chunks c JOIN chunk_pieces p ON p.chunk = c.chunk GROUP BY c.doc_id)
"""


def tokenised(spark: SparkSession, folder: str, **options) -> DataFrame:
    return T.tokenise(_docs(spark, folder), vocabulary_file(spark, folder), **options)


@query("tokenised", "WITH RECURSIVE " + ctes(_PIECES, _MATCHED)[5:] + """
    SELECT doc_id, array_to_string(ids, ' ') AS input_ids, CAST(len(ids) AS INTEGER) AS attention,
      0 AS types, 2 AS specials FROM token_ids""")
def tokenised_documents(spark, folder):
    """Word pieces with start and end tokens and the parallel masks."""
    return _token_report(tokenised(spark, folder))


def _token_report(tokens: DataFrame) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return tokens.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        total("attention_mask").alias("attention"),
        total("token_type_ids").alias("types"),
        total("special_tokens_mask").alias("specials"),
    )


@query("tokenised_native", "WITH RECURSIVE " + ctes(_PIECES, _MATCHED)[5:] + """
    SELECT doc_id, array_to_string(ids, ' ') AS input_ids, CAST(len(ids) AS INTEGER) AS attention,
      0 AS types, 2 AS specials FROM token_ids""")
def tokenised_native(spark, folder):
    """The same pieces without Python workers, by joins over the distinct words."""
    vocab = scan_vocabulary(spark, vocabulary_file(spark, folder))
    return _token_report(tokenise_native(_docs(spark, folder), staged(vocab, "pieces"), "doc_id"))


@query("tokenised_fixed_length", "WITH RECURSIVE " + ctes(_PIECES, _MATCHED)[5:] + """
    , fixed AS (
      SELECT doc_id, least(len(ids), 64) AS n,
        list_concat(list_concat(ids[1:least(len(ids), 64) - 1], [3]), [0 FOR x IN range(64 - least(len(ids), 64))]) AS ids
      FROM token_ids)
    SELECT doc_id, array_to_string(ids, ' ') AS input_ids, CAST(n AS INTEGER) AS attention,
      CAST(64 - n + 2 AS INTEGER) AS specials FROM fixed""")
def tokenised_fixed_length(spark, folder):
    """The same cut to 64 pieces, the end token kept, and padded."""
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return tokenised(spark, folder, max_length=64, pad=True).select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        total("attention_mask").alias("attention"),
        total("special_tokens_mask").alias("specials"),
    )


_LENGTHS = "[length(w) FOR w IN string_split(text, ' ')]"


@query("fixed_length", f"""
    SELECT doc_id, array_to_string(list_concat(l[1:50], [0 FOR x IN range(50 - least(len(l), 50))]), ' ') AS padded,
      array_to_string(l[1:50], ' ') AS cut
    FROM (SELECT doc_id, {_LENGTHS} AS l FROM documents)""")
def fixed_length_arrays(spark, folder):
    lengths = F.transform(F.split("text", " "), F.length)
    return _joined(
        _docs(spark, folder).withColumn("l", lengths).select(
            "doc_id", fixed_length(F.col("l"), 50, 0).alias("padded"), truncated(F.col("l"), 50).alias("cut")
        ),
        "padded", "cut",
    )


# --- packing and masking ----------------------------------------------------


_TOKENS = "WITH RECURSIVE " + ctes(_PIECES, _MATCHED)[5:].rstrip()


def _packable(spark: SparkSession, folder: str) -> DataFrame:
    """Stored piece ids with their masks; packing reads them several times."""
    return staged(tokenised(spark, folder).drop("text"), "tokens")


def _scored_tokens(spark: SparkSession, folder: str, *metrics: str) -> DataFrame:
    """The same of scored articles; pieces are found where the scores are, so no array meets its scores by a join."""
    rows = scored(spark, folder).select(F.col("id").alias("doc_id"), "text", *metrics)
    return staged(T.tokenise(rows, vocabulary_file(spark, folder), drop=["text"]), "scored_tokens")


def _packed_sql(length: int, batch: int) -> str:
    return f"""{_TOKENS},
    {ORDERED},
    wrapped AS (SELECT o.ordinal, t.ids FROM token_ids t JOIN ordered o ON o.doc_id = t.doc_id),
    spans AS (
      SELECT ordinal // {batch} AS batch, ids, sum(len(ids)) OVER (PARTITION BY ordinal // {batch} ORDER BY ordinal) - len(ids) AS start
      FROM wrapped),
    tokens AS (
      SELECT batch, start + i AS pos, ids[i + 1] AS id, i = 0 OR i = len(ids) - 1 AS special
      FROM (SELECT batch, ids, start, unnest(range(len(ids))) AS i FROM spans)),
    packed AS (
      SELECT batch, CAST(pos // {length} AS BIGINT) AS chunk, list(id ORDER BY pos) AS ids, list(special ORDER BY pos) AS special
      FROM tokens GROUP BY ALL)"""


_PACKED_COLUMNS = f"""
    SELECT CAST(batch AS BIGINT) AS batch, chunk,
      array_to_string(list_concat(ids, [0 FOR x IN range({{0}} - len(ids))]), ' ') AS input_ids,
      CAST(len(ids) AS INTEGER) AS attention,
      CAST(len([x FOR x IN special IF x]) + {{0}} - len(ids) AS INTEGER) AS specials FROM packed"""


def _packed_report(rows: DataFrame, *keep: str) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x)
    return rows.select(
        *keep,
        F.col("batch").cast("long").alias("batch"),
        F.col("chunk").cast("long").alias("chunk"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        total("attention_mask").alias("attention"),
        total("special_tokens_mask").alias("specials"),
    )


@query("packed_rows", _packed_sql(512, 1024) + _PACKED_COLUMNS.format(512))
def packed_rows(spark, folder):
    """Shuffled documents in rows of 512 tokens, batches of 1024 documents."""
    return _packed_report(T.pack_shuffled(_packable(spark, folder), "doc_id", 512, batch_size=1024))


@query("packed_rows_small_batches", _packed_sql(PACK_LENGTH, PACK_BATCH) + _PACKED_COLUMNS.format(PACK_LENGTH))
def packed_rows_small_batches(spark, folder):
    """Shorter rows and batches, with batches that end inside and across buckets."""
    rows = T.pack_shuffled(_packable(spark, folder), "doc_id", PACK_LENGTH, batch_size=PACK_BATCH, digits=1)
    return _packed_report(rows)


_TRAINING = _TOKENS + "," + ctes(*SCORED_ALL)[5:].rstrip() + """,
    wrapped AS (
      SELECT s.id, s.sjr, w.ids,
        row_number() OVER (ORDER BY md5(s.id || '|42'), s.id) AS place, count(*) OVER () AS total
      FROM scored s JOIN token_ids w ON w.doc_id = s.id),
    divided AS (
      SELECT *, CASE WHEN place > total - ceil(total / 10.0) THEN 'validation' ELSE 'train' END AS split FROM wrapped),
    kept AS (
      SELECT split, ids, row_number() OVER (PARTITION BY split ORDER BY place) - 1 AS ordinal
      FROM divided WHERE split = 'validation' OR sjr BETWEEN 0.759 AND 100),
    spans AS (
      SELECT split, ordinal // 64 AS batch, ids,
        sum(len(ids)) OVER (PARTITION BY split, ordinal // 64 ORDER BY ordinal) - len(ids) AS start FROM kept),
    tokens AS (
      SELECT split, batch, start + i AS pos, ids[i + 1] AS id, i = 0 OR i = len(ids) - 1 AS special
      FROM (SELECT split, batch, ids, start, unnest(range(len(ids))) AS i FROM spans)),
    packed AS (
      SELECT split, batch, CAST(pos // 128 AS BIGINT) AS chunk, list(id ORDER BY pos) AS ids, list(special ORDER BY pos) AS special
      FROM tokens GROUP BY ALL)"""


@query("training_rows", _TRAINING + _PACKED_COLUMNS.format(128).replace("SELECT", "SELECT split,", 1))
def training_rows(spark, folder):
    """Scored articles to token rows: split, metric band on the training part, packing."""
    tokens = _scored_tokens(spark, folder, "sjr")
    band = Band("sjr", 0.759, 100.0, "top50%")
    rows = jobs.training_rows(tokens, "doc_id", length=128, band=band, fraction=0.1, batch_size=64)
    return _packed_report(rows, "split")


_BANDED = _TOKENS + "," + ctes(*SCORED_ALL)[5:].rstrip() + f""",
    bands AS (SELECT * FROM (VALUES {BAND_ROWS}) AS t(band, metric, low, high)),
    wrapped AS (
      SELECT b.band, w.ids, row_number() OVER (PARTITION BY b.band ORDER BY md5(s.id || '|42'), s.id) - 1 AS ordinal
      FROM scored s JOIN token_ids w ON w.doc_id = s.id JOIN bands b ON b.metric = 'none'
        OR CASE b.metric WHEN 'sjr' THEN s.sjr WHEN 'h-index' THEN s.h_index ELSE s.random END BETWEEN b.low AND b.high),
    spans AS (
      SELECT band, ordinal // 64 AS batch, ids, sum(len(ids)) OVER (PARTITION BY band, ordinal // 64 ORDER BY ordinal) - len(ids) AS start
      FROM wrapped),
    tokens AS (
      SELECT band, batch, start + i AS pos, ids[i + 1] AS id, i = 0 OR i = len(ids) - 1 AS special
      FROM (SELECT band, batch, ids, start, unnest(range(len(ids))) AS i FROM spans)),
    packed AS (
      SELECT band, batch, CAST(pos // 128 AS BIGINT) AS chunk, list(id ORDER BY pos) AS ids, list(special ORDER BY pos) AS special
      FROM tokens GROUP BY ALL)"""


@query("packed_rows_by_band", _BANDED + _PACKED_COLUMNS.format(128).replace("SELECT", "SELECT band,", 1))
def packed_rows_by_band(spark, folder):
    """The training rows of all ten bands from one pass over the shuffled tokens."""
    tokens = _scored_tokens(spark, folder, "sjr", "h_index", "random")
    return _packed_report(T.pack_bands(tokens, "doc_id", BANDS, PACK_LENGTH, batch_size=PACK_BATCH, digits=1), "band")


_PACKS = ((128, 64), (512, 256))


@query("packed_from_store", _TOKENS + f""",
    {ORDERED},
    wrapped AS (SELECT o.ordinal, t.ids FROM token_ids t JOIN ordered o ON o.doc_id = t.doc_id),
    spans AS (
      SELECT l.length, ordinal // l.size AS batch, ids, sum(len(ids)) OVER (PARTITION BY l.length, ordinal // l.size ORDER BY ordinal) - len(ids) AS start
      FROM wrapped, (VALUES {", ".join(map(str, _PACKS))}) l(length, size)),
    tokens AS (
      SELECT length, batch, start + i AS pos, ids[i + 1] AS id, i = 0 OR i = len(ids) - 1 AS special
      FROM (SELECT length, batch, ids, start, unnest(range(len(ids))) AS i FROM spans)),
    packed AS (
      SELECT length, batch, CAST(pos // length AS BIGINT) AS chunk, list(id ORDER BY pos) AS ids, list(special ORDER BY pos) AS special
      FROM tokens GROUP BY ALL)""" + _PACKED_COLUMNS.replace("{0}", "length").replace("SELECT", "SELECT CAST(length AS INTEGER) AS length,", 1))
def packed_from_store(spark, folder):
    """Two packings of one stored order; neither moves the arrays again."""
    store = store_tokens(_packable(spark, folder), "doc_id", slab_rows=256, digits=1)
    short, long = (pack_stored(spark, store, n, batch_size=size).withColumn("length", F.lit(n)) for n, size in _PACKS)
    return _packed_report(short.unionByName(long), "length")


@query("split_from_store", ctes(ORDERED) + """
    SELECT doc_id, ordinal, CASE WHEN ordinal >= total - ceil(total / 20.0) THEN 'validation' ELSE 'train' END AS split FROM ordered""")
def split_from_store(spark, folder):
    """The tail of the stored order is held out by a comparison of positions."""
    store = store_tokens(documents(spark, folder).select("doc_id"), "doc_id", slab_rows=128)
    return split_stored(spark, store, 0.05).select("doc_id", "ordinal", "split")


# Requests that are unset, below and above what a model takes.
_REQUESTS = ((None, 4096, 1024), (96, 512, 96), (900, 128, 128))


@query("packed_to_sequence_length", _TOKENS + f""",
    {ORDERED},
    wrapped AS (SELECT o.ordinal, t.ids FROM token_ids t JOIN ordered o ON o.doc_id = t.doc_id),
    spans AS (
      SELECT l.length, ordinal // 64 AS batch, ids, sum(len(ids)) OVER (PARTITION BY l.length, ordinal // 64 ORDER BY ordinal) - len(ids) AS start
      FROM wrapped, (VALUES {", ".join(f"({length})" for *_, length in _REQUESTS)}) l(length)),
    tokens AS (
      SELECT length, batch, start + i AS pos, ids[i + 1] AS id, i = 0 OR i = len(ids) - 1 AS special
      FROM (SELECT length, batch, ids, start, unnest(range(len(ids))) AS i FROM spans)),
    packed AS (
      SELECT length, batch, CAST(pos // length AS BIGINT) AS chunk, list(id ORDER BY pos) AS ids, list(special ORDER BY pos) AS special
      FROM tokens GROUP BY ALL)""" + _PACKED_COLUMNS.replace("{0}", "length").replace("SELECT", "SELECT CAST(length AS INTEGER) AS length,", 1))
def packed_to_sequence_length(spark, folder):
    """Rows as long as the request and the model allow."""
    lengths = [T.sequence_length(requested, model_max) for requested, model_max, _ in _REQUESTS]
    packed = T.pack_lengths(_packable(spark, folder), "doc_id", lengths, batch_size=PACK_BATCH)
    parts = [rows.withColumn("length", F.lit(length)) for rows, length in zip(packed, lengths)]
    return _packed_report(parts[0].unionByName(parts[1]).unionByName(parts[2]), "length")


@query("first_packed_rows", _packed_sql(PACK_LENGTH, PACK_BATCH) + _PACKED_COLUMNS.format(PACK_LENGTH) + """
    ORDER BY batch, chunk LIMIT 200""")
def first_packed_rows(spark, folder):
    """A cap on the packed training rows."""
    rows = T.pack_shuffled(_packable(spark, folder), "doc_id", PACK_LENGTH, batch_size=PACK_BATCH)
    return _packed_report(T.first_packed(rows, 200))


def _draw(i: str) -> str:
    return f"substr(md5(rowkey || '|' || ({i} // 4) || '|42'), CAST(({i} % 4) * 8 + 1 AS INTEGER), 8)"


def _hex(share: float) -> str:
    return format(int(round(share * 2**32)), "08x")


_MASKED = _TOKENS + f""",
    tokens AS (
      SELECT rowkey, i, ids[i + 1] AS t, i > 0 AND i < len(ids) - 1 AS plain FROM (
        SELECT doc_id AS rowkey, ids, unnest(range(len(ids))) AS i FROM token_ids)),
    drawn AS (SELECT *, {_draw("i")} AS u FROM tokens),
    picked AS (SELECT *, plain AND u < '{_hex(0.15)}' AS chosen FROM drawn)
    SELECT rowkey AS doc_id,
      string_agg(CASE WHEN NOT chosen THEN t WHEN u < '{_hex(0.15 * 0.8)}' THEN 4
        WHEN u < '{_hex(0.15 * 0.9)}' THEN CAST(('0x' || substr(md5(rowkey || '|' || i || '|random|42'), 1, 8)) AS BIGINT) % 30000
        ELSE t END, ' ' ORDER BY i) AS input_ids,
      string_agg(CASE WHEN chosen THEN t ELSE -100 END, ' ' ORDER BY i) AS labels
    FROM picked GROUP BY rowkey"""


@query("masked_tokens", _MASKED)
def masked_tokens(spark, folder):
    rows = T.mask_tokens(_packable(spark, folder), F.col("doc_id"), mask_id=4, vocab_size=30000)
    return _joined(rows.select("doc_id", "input_ids", "labels"), "input_ids", "labels")


@query("training_columns", _TOKENS + " SELECT doc_id, CAST(len(ids) AS INTEGER) AS n FROM token_ids")
def training_columns(spark, folder):
    """Only the token columns of a dataset are kept for training."""
    rows = _packable(spark, folder).withColumn("extra", F.lit("x"))
    kept = rows.select("doc_id", *[c for c in T.PACK_FILLS if c in rows.columns])
    return kept.select("doc_id", F.size("input_ids").alias("n"))
