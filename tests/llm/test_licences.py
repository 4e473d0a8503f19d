import textwrap

import pytest
from pyspark.sql import functions as F

from corposcope.llm import licences


@pytest.fixture(scope="module")
def trained(spark, documents):
    return licences.train(spark, documents.select("doc_id", "text"))


def families(spark, trained, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.licence_paragraphs(rows, *trained).collect()
    return {r.doc_id: r.family for r in found}


def test_templates_and_variants(spark, trained):
    texts = [t for ts in licences.TEMPLATES.values() for t in ts]
    want = [f for f, ts in licences.TEMPLATES.items() for _ in ts]
    got = families(spark, trained, texts)
    assert sum(got.get(i) == f for i, f in enumerate(want)) >= 0.95 * len(want)
    variants = {
        "The code is distributed under the MIT License": "MIT",
        "licensed under the apache license version 2.0 see below": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 2": "GPL",
        "Texts are licensed under CC BY-NC 4.0!": "CC-BY-NC",
    }
    got = families(spark, trained, list(variants))
    assert [got[i] for i in range(len(variants))] == list(variants.values())


def test_unknown_paragraphs(spark, trained):
    texts = [*licences.OTHERS, "My fishing license is in the drawer", "All permission slips are due on Monday", "prose without a cue"]
    assert set(families(spark, trained, texts).values()) <= {licences.UNKNOWN}


GRANTS = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
}


@pytest.mark.parametrize("width", [24, 40, 72, 80])
@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_wrapped_notices(spark, trained, width, mark):
    texts, want = [], []
    for family, grant in GRANTS.items():
        lines = [mark + w for w in textwrap.wrap(grant, width)]
        prose = ["The cat sat on a mat and saw nine small birds.", "They flew over old stone walls."]
        texts += ["\n".join(lines), "\n".join([*prose, *lines, *prose]), "\n".join([*lines, mark, *lines])]
        want += [(1, 0, len(lines)), (1, 2, 4 + len(lines)), (2, 0, 2 * len(lines))]
        texts += ["\n".join([*lines, *lines])]
        want += [(2, 0, 2 * len(lines))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.licence_paragraphs(rows, *trained).where("family <> 'unknown'").collect()
    for i, (n, at, _) in enumerate(want):
        mine = [r for r in found if r.doc_id == i]
        assert [r.family for r in mine] == [list(GRANTS)[i // 4]] * n, texts[i]
        assert min(r.at for r in mine) == at
    assert {tuple(sorted(r.asDict())) for r in found} == {("at", "doc_id", "family", "matched", "paragraph", "score")}


def test_wrapped_notices_are_counted(spark, documents):
    text = "\n\n".join("\n".join(textwrap.wrap(g, 72)) for g in GRANTS.values())
    more = spark.createDataFrame([(-1, text), (-2, "The permission\nslips of the\nclass are lost")], "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scan_licences(documents.select("doc_id", "text").unionByName(more)).where("doc_id < 0").collect()}
    # The line of the GPL header after the template's end has a cue of its own.
    assert (rows[-1].families, rows[-1].n_licences, rows[-1].n_unknown) == ("BSD,GPL,MIT", 3, 1)
    assert (rows[-2].families, rows[-2].n_licences, rows[-2].n_unknown) == ("", 0, 1)


def test_odd_rows(odd, odd_rows, none):
    rows = licences.scan_licences(odd).collect()
    assert len(rows) == len(odd_rows)
    found = {r.doc_id: r for r in rows}
    assert found[15].families == "MIT" and found[15].n_licences == 1 and found[15].n_paragraphs == 2
    assert all(r.n_licences == 0 and r.families == "" for r in rows if r.doc_id != 15)
    assert licences.scan_licences(none).collect() == []


def test_documents_against_their_lines(documents):
    cue = r"(?m)^.{0,30}(licensed|released) under (the|CC)"
    rows = licences.scan_licences(documents).join(documents.select("doc_id", F.col("text").rlike("(?i)" + cue).alias("has")), "doc_id").collect()
    assert sum((r.n_licences > 0) == r.has for r in rows) >= 0.98 * len(rows)


def test_every_template_has_a_cue():
    import re

    assert all(re.search(licences.CUES, t) for ts in licences.TEMPLATES.values() for t in ts)


def test_cues_over_a_line_break():
    import re

    assert all(re.search(licences.SPREAD_CUES, t) for t in ("free\n * software", "public\n12:# domain", "CC\nBY 4.0", "rights\nreserved"))
    assert not re.search(licences.SPREAD_CUES, "the public was given a domain")


CUELESS = {
    "BSD": "use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Proprietary": "Unauthorized copying of this file is strictly prohibited.",
}


def test_notices_without_a_cue_word(spark, trained):
    import re

    assert not any(re.search(licences.CUES, t) for t in CUELESS.values())
    assert families(spark, trained, list(CUELESS.values())) == dict(enumerate(CUELESS))
    wrapped = families(spark, trained, ["\n".join(textwrap.wrap(t, 30)) for t in CUELESS.values()])
    assert wrapped == dict(enumerate(CUELESS))


def trigrams(text):
    import re

    words = re.findall(r"[a-z0-9]+", text.lower())
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def test_whatever_can_be_confirmed_is_looked_at():
    """Leave out every trigram with a cover word or a cue in one word: of no template is enough left."""
    import re

    cover = set(licences.cover_words(licences.TEMPLATES))
    for texts in licences.TEMPLATES.values():
        for text in texts:
            runs = trigrams(text)
            bare = [r for r in runs if not cover & set(r) and not any(re.search(licences.CUES, w) for w in r)]
            assert len(bare) < max(licences.CONFIRMED * len(runs), 1), text


def test_matched_shares_restated(spark, documents):
    """The share of each template in every line of all documents, by sets of trigrams in plain Python."""
    lines = documents.select("doc_id", F.posexplode(licences.paragraphs()).alias("at", "text"))
    got = {(r.doc_id, r.at, r.family): r.matched for r in licences.template_matches(lines.select("doc_id", "at", licences._words(F.col("text")).alias("words"))).collect()}
    want = {}
    for r in lines.collect():
        own = trigrams(r.text)
        for family, texts in licences.TEMPLATES.items():
            share = max(len(own & trigrams(t)) / len(trigrams(t)) for t in texts)
            if share:
                want[r.doc_id, r.at, family] = share
    assert got == pytest.approx(want)


def test_every_scored_line_is_an_example(spark):
    """No document is left out of the training, and many unknown lines don't hide a template."""
    text = F.concat(F.lit("prose alone\nThe licence plate "), F.col("id"), F.lit(" was lost\n\nReleased under the MIT License."))
    looked = licences.looked_at(spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text")))
    drawn = licences.training_paragraphs(spark, looked).where("drawn")
    assert drawn.select("words").distinct().count() == drawn.count() == 3000
    assert 400 < drawn.where("held_out").count() < 800
    found = licences._paragraphs(looked, *licences._trained(spark, looked)).groupBy("family").count().collect()
    assert dict(found) == {"MIT": 3000, "unknown": 3000}
