"""Decontamination, personal data, language, quality and licences against brute force."""

import hashlib

import pytest

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm import helpers
from tests.llm.helpers import table

LONG = "word " * 60_000


def docs_of(spark, texts, **extra):
    rows = [(i, t, "en", "s", 0, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `row` string")


# ---------------------------------------------------------------- decontamination
def test_contamination_query_matches_brute_force(spark):
    from tabforge.llm.queries import QUERIES
    d, b = table(SF_ORACLE, "documents"), table(SF_ORACLE, "benchmark")
    want = helpers.contamination(zip(d["doc_id"], d["text"]), list(zip(b["item_id"], b["text"])))
    assert sorted(map(tuple, QUERIES["op7_decontaminate"](spark, SF_ORACLE).collect())) == sorted(want)


@pytest.mark.parametrize("slice_words", [4_000_000, 20])
def test_contamination_cases(spark, slice_words):
    from tabforge.llm.decontaminate import contamination, drop_contaminated
    item = " ".join(f"k{i}" for i in range(20))
    items = [(1, item), (2, "Short ITEM"), (3, None), (4, "--"), (5, item), (5, item), (None, "lone")]
    texts = [None, "", item.upper(), "x " * 30 + " ".join(f"k{i}" for i in range(12)), "a short item, b", "short", LONG + item,
             "x short item y " + "w " * 60, "lone", "--"] + [item] * 2
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts)
    want = helpers.contamination(enumerate(texts), [("null" if i is None else i, t) for i, t in items])
    got = contamination(docs, bench, slice_words=slice_words).drop("spans", "items").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    kept = drop_contaminated(docs, bench, slice_words=slice_words)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if not w[-1])
    assert contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(docs.limit(0), bench).count() == 0


def test_clashing_hashes_do_not_hit(spark, monkeypatch):
    """One bucket for all windows, and windows whose codes agree but whose words do not."""
    import numpy as np
    import pyarrow as pa
    from tabforge.llm import decontaminate as dc
    items = [("a", "one two three"), ("b", "four five six seven"), ("b2", "Four five, six seven"), ("c", "x")]
    windows = dc.benchmark_windows(spark.createDataFrame(items, "item_id string, text string"), 3).toArrow()
    assert sorted(r["raw"] for r in windows.to_pylist()) == [b"five six seven", b"four five six", b"one two three", b"x"]
    text = "zero one two three x Four five six seven"
    buf, offs = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)])
    real = dc.gram_hashes_rows
    monkeypatch.setattr(dc, "gram_hashes_rows", lambda w: np.zeros(len(w), np.uint64))
    n, spans, found = dc.scan_run(buf, offs, dc.pattern_tables(windows))
    assert n.tolist() == [9] and spans == [[1, 9]] and sorted(found[0]) == ["a", "b", "b2", "c"]
    monkeypatch.setattr(dc, "gram_hashes_rows", real)
    other = windows.set_column(windows.schema.get_field_index("raw"), "raw", pa.array([b"other words"] * windows.num_rows))
    assert dc.scan_run(buf, offs, dc.pattern_tables(other))[1:] == ([[]], [[]])


# ---------------------------------------------------------------- personal data
TRICKY = ["a@b.c@d.e", "x.y@z", "@a.b", "a..b@-.-x", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4", "4111 1111 1111 1111-0 4111-1111-1111-1111",
          "4111111111111111", "+1 (017) 555-7713 +12 +1234567890123456", "+1 2 3 4 5 6 7 8 9 0x", "é4111111111111111é", "1" * 500, "1.1." * 200,
          "a@" * 300, "+1+1+1", "٤111111111111111 4٣", None, "", "5" + " 5" * 15]


def test_base_spans_are_those_of_the_patterns():
    import random
    from tabforge.llm.personal_data import base_spans
    rng = random.Random(2)
    texts = TRICKY + ["".join(rng.choices("ab1234.@+- ()%_é", k=rng.randint(0, 60))) for _ in range(20_000)]
    for t in texts:
        assert base_spans(t or "") == helpers.base_spans(t), t


def test_personal_data_query(spark):
    from tabforge.llm.personal_data import spell
    from tabforge.llm.queries import QUERIES
    d = dict(zip(*(table(SF_SMALL, "documents")[c] for c in ("doc_id", "text"))))
    for r in QUERIES["op5_personal_data"](spark, SF_SMALL).collect():
        base = helpers.base_spans(d[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(spell(base).encode()).hexdigest()
        assert set(filter(None, spell(base).split(","))) <= set(r.spans.split(","))


def test_field_adds_repeated_tokens_only(spark):
    from tabforge.llm.personal_data import find_personal_data, mask_personal_data, train
    phone = [f"call +1 ({i:03d}) 555-{i * 37 % 10000:04d} today" for i in range(100, 160)]
    plain = [f"in {1900 + i} we had {i} of them" for i in range(60)]
    w = train(docs_of(spark, phone + plain))
    texts = ["call +1 (017) 555-7713 now. Later: (017) 555-7713 again.", "room (017) 555-7713", "in 1984 or 1984", None, "", LONG]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r.spans for r in find_personal_data(docs, w).collect()}
    assert got[0] == "phone:5:22,phone:35:49"
    assert [got[i] for i in (1, 2, 3, 4, 5)] == [""] * 5
    masked = mask_personal_data(docs)
    assert masked.columns == docs.columns
    out = {r.doc_id: r for r in masked.collect()}
    assert out[0].text.startswith("call <PHONE> now.") and out[0].n_chars == len(out[0].text) and out[3].text is None
    assert mask_personal_data(docs.limit(0)).count() == 0


def test_messages_are_exact_on_a_chain():
    """On a graph without cycles, sum-product equals enumeration."""
    import itertools
    import numpy as np
    from tabforge.llm.personal_data import L, Graph, Weights, marginals
    g = Graph(["12 34 x 12"], [[]])
    rng = np.random.default_rng(0)
    w = Weights()
    w.unary, w.trans, w.skip = rng.normal(size=w.unary.shape), rng.normal(size=(L, L)), np.array([0.7, 0.3])
    assert [e.tolist() for e in g.edges] == [[[0, 1]], [[0, 2]], []]
    s, total = w.local(g), np.zeros((3, L))
    for y in itertools.product(range(L), repeat=3):
        p = np.exp(s[0, y[0]] + s[1, y[1]] + s[2, y[2]] + w.trans[y[0], y[1]] + w.skip[0] * (y[0] == y[2]))
        for i in range(3):
            total[i, y[i]] += p
    assert np.allclose(marginals(g, w, turns=60), total / total.sum(axis=1, keepdims=True), atol=1e-6)


# ---------------------------------------------------------------- language
def test_language_held_out_accuracy(spark):
    from tabforge.llm.queries import QUERIES
    lang = dict(zip(*(table(SF_ORACLE, "documents")[c] for c in ("doc_id", "lang"))))
    got = QUERIES["op9_language"](spark, SF_ORACLE).collect()
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    import zlib
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_mixture_and_cases(spark):
    from tabforge.llm.language import drop_unknown, identify, train
    d = table(SF_SMALL, "documents")
    by = {}
    for t, x in zip(d["text"], d["lang"]):
        by.setdefault(x, []).append(t)
    model = train(docs_of(spark, []).union(spark.createDataFrame([(i, t, x, "s", 0, "c") for i, (t, x) in enumerate(zip(d["text"], d["lang"]))],
                                                                 docs_of(spark, []).schema)))
    texts = [by["de"][0][:1500] + " " + by["es"][0][:900], None, "", "12 .. !!", "…—", "ab", by["fr"][1], LONG]
    docs = docs_of(spark, texts)
    got = {r.doc_id: r for r in identify(docs, *model).collect()}
    assert got[0].lang_pred == "de" and set(got[0].mixture) == {"de", "es"} and 0.4 < got[0].score < 0.8
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4 and got[1].score == 0.0
    assert got[6].lang_pred == "fr" and got[5].lang_pred != "und"
    assert sorted(r.doc_id for r in drop_unknown(docs, *model).collect()) == [0, 5, 6, 7]
    assert {r.lang_pred for r in identify(docs, *train(docs.limit(0))).collect()} == {"und"}
    assert identify(docs.limit(0), *model).count() == 0


# ---------------------------------------------------------------- quality
def test_quality_held_out(spark):
    import zlib
    from tabforge.llm.queries import QUERIES
    lab = dict(zip(*(table(SF_ORACLE, "labels")[c] for c in ("doc_id", "quality"))))
    got = {r.doc_id: r for r in QUERIES["op8_quality"](spark, SF_ORACLE).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[i].score, q) for i, q in lab.items() if got[i].held_out]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((a > b) for a in good for b in bad) >= 0.95 * len(good) * len(bad)


def test_quality_cases(spark):
    from tabforge.llm.quality import score, train, word_vectors
    docs = docs_of(spark, ["good plain words here"] * 20 + ["###!! ###!! $$$"] * 20 + [None, "", LONG])
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    vec = word_vectors(docs)
    net = train(docs, labels, vec)
    got = {r.doc_id: r.score for r in score(docs, vec, net).collect()}
    assert min(got[i] for i in range(20)) > max(got[i] for i in range(20, 40)) and all(0 <= s <= 1 for s in got.values())
    assert train(docs, labels.limit(0), vec) is None
    assert {r.score for r in score(docs, word_vectors(docs.limit(0)), None).collect()} == {0.5}


# ---------------------------------------------------------------- licences
def test_licence_rules(spark):
    from tabforge.llm.licences import scan_licences
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy.\nThe above copyright notice and this permission "
           "notice shall be included in all copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND.")
    texts = [mit, "Some prose. " + mit + " More prose. Licensed under the Apache Licence, Version 2.0.", mit.split("\n")[0], None, "",
             "All rights reserved.", "SPDX-License-Identifier: GPL-3.0-or-later\n", LONG]
    got = {r.doc_id: (r.licences, r.n_licences, r.n_unknown) for r in scan_licences(docs_of(spark, texts)).collect()}
    assert got == {0: ("MIT", 1, 0), 1: ("Apache-2.0,MIT", 2, 0), 2: ("", 0, 1), 3: ("", 0, 0), 4: ("", 0, 0), 5: ("", 0, 1),
                   6: ("GPL-3.0-or-later", 1, 0), 7: ("", 0, 0)}
    assert scan_licences(docs_of(spark, texts).limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 A

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer.

"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.

You should have received a copy of the GNU General Public License
along with this program."""


def test_published_licence_notices(spark):
    from tabforge.llm.licences import RULES, _seq, scan_licences
    notices = {"MIT": MIT, "BSD-2-Clause": BSD2 + AS_IS, "BSD-3-Clause": BSD2 + ENDORSE + AS_IS, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL3}
    cases = []
    for name, text in notices.items():
        whole = _seq(max((ids for rule, ids in RULES if rule == name), key=len))
        joined = "\n\n".join(" ".join(part.split()) for part in text.split("\n\n"))
        leaders = "\n".join(f"# {line}".rstrip() for line in text.split("\n"))
        cases += [(t, name, whole) for t in (text, joined, leaders, text.replace("\n", "\r\n"))]
    cases += [("# SPDX-License-Identifier: MIT\n# Author: A\nimport os", "MIT", "<mit_ref>"), ("MIT License\nCopyright A", "MIT", "<mit_ref>")]
    got = {r.doc_id: r for r in scan_licences(docs_of(spark, [t for t, _, _ in cases])).collect()}
    for i, (text, name, whole) in enumerate(cases):
        assert got[i].licences == name and whole in got[i].sentence_ids, (text, got[i])


def test_licence_oracle(spark):
    from tabforge.llm.queries import ORACLES, QUERIES
    from tabforge.plans.verify import compare
    assert compare(spark, "op3_licences", QUERIES["op3_licences"], ORACLES["op3_licences"], SF_SMALL)["status"] == "ok"
