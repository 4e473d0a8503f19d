"""Queries over the seeded order of the documents."""

from __future__ import annotations

from ..operators import ordering as O
from .registry import ctes, query
from .tables import ORDERED, table


def _docs(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "n_chars")


@query("global_ordinal", ctes(ORDERED) + """
    SELECT o.doc_id, d.n_chars, o.ordinal FROM ordered o JOIN documents d ON d.doc_id = o.doc_id""")
def global_ordinal(spark, folder):
    return O.with_ordinal(_docs(spark, folder), "doc_id")


@query("seeded_shuffle", ctes(ORDERED) + """
    SELECT o.doc_id, d.text FROM ordered o JOIN documents d ON d.doc_id = o.doc_id ORDER BY o.ordinal""")
def seeded_shuffle(spark, folder):
    return O.seeded_shuffle(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


@query("train_validation_split", ctes(ORDERED) + """
    SELECT doc_id, CASE WHEN ordinal >= total - ceil(total * 5 / 100.0) THEN 'validation' ELSE 'train' END AS split
    FROM ordered""")
def train_validation_split(spark, folder):
    return O.train_validation_split(_docs(spark, folder).select("doc_id"), "doc_id", 0.05)


@query("hashed_split", """
    SELECT doc_id, CASE WHEN substr(md5(doc_id || '|42'), 1, 13) < 'fd70a3d70a3d7' THEN 'train' ELSE 'validation' END AS split
    FROM documents""")
def hashed_split(spark, folder):
    return O.hashed_split(_docs(spark, folder).select("doc_id"), "doc_id", 0.01)


@query("first_rows", ctes(ORDERED) + """
    SELECT o.doc_id, d.n_chars FROM ordered o JOIN documents d ON d.doc_id = o.doc_id WHERE ordinal < 100""")
def first_rows(spark, folder):
    """The head of the order as a training set cap."""
    return O.first_rows(_docs(spark, folder), 100, "doc_id")


@query("first_half", ctes(ORDERED) + """
    SELECT o.doc_id, d.n_chars FROM ordered o JOIN documents d ON d.doc_id = o.doc_id
    WHERE ordinal < (SELECT count(*) // 2 FROM documents)""")
def first_half(spark, folder):
    """A large cap: rows before the key at the cut."""
    docs = _docs(spark, folder)
    return O.first_rows(docs, docs.count() // 2, "doc_id")


@query("sample_rows", """
    SELECT doc_id, n_chars FROM documents ORDER BY md5(doc_id || '|0'), doc_id LIMIT 3""")
def sample_rows(spark, folder):
    return O.sample_rows(_docs(spark, folder), "doc_id", 3)
