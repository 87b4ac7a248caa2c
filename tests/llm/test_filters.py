"""Language identification, quality classifier, licence scan."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from learnmetrics.llm import langid, licenses, quality
from learnmetrics.llm.common import is_training_row, table
from learnmetrics.llm.training import bounded_sample

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, "123 !!"), (3, "the thing"), (None, "word " * 30_000), (4, " \n\t ")]


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=(4, 2, 3)).astype(np.float32)
    scores[3, 1] = np.nan  # the second sequence is shorter
    step, start = rng.normal(size=(3, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32)
    gamma, expected = langid.forward_backward(scores.copy(), step, start)
    pairs = np.zeros((3, 3))
    for b, n in ((0, 4), (1, 3)):
        mass, total, seen = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for y in itertools.product(range(3), repeat=n):
            v = start[y[0]] + sum(scores[t, b, y[t]] for t in range(n)) + sum(step[y[t - 1], y[t]] for t in range(1, n))
            v = np.exp(v)
            total += v
            for t in range(n):
                mass[t, y[t]] += v
            for t in range(1, n):
                seen[y[t - 1], y[t]] += v
        assert np.abs(mass / total - gamma[:n, b]).max() < 1e-6
        pairs += seen / total
    assert np.abs(pairs - expected).max() < 1e-5


def test_word_features_mark_affixes_and_lexicon():
    ids, bounds = langid.word_features(["ab", "ab", "b"], {"ab": 7})
    one, two, three = (ids[bounds[i] : bounds[i + 1]] for i in range(3))
    assert one.tolist() == two.tolist() and one[-1] == langid.HASHED + 7 and three[-1] == langid.HASHED
    # ^ a b $: four unigrams, three bigrams, two trigrams, one 4-gram, the lexicon entry
    assert len(one) == 11


def test_language_held_out_accuracy_and_odd_rows(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    out = langid.identify(docs, model).where(~is_training_row()).toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    odd = langid.identify(spark.createDataFrame(ODD, DOCS).selectExpr("*", "'x' as score"), model, segments=True)
    assert odd.columns == ["doc_id", "text", "lang_pred", "score", "segments"]
    rows = odd.collect()
    assert [r.lang_pred for r in rows if not (r.text and any(c.isalpha() for c in r.text))] == ["und"] * 4
    long = next(r for r in rows if r.doc_id is None)
    assert sum(s.words for s in long.segments) == 30_000
    mixed = spark.createDataFrame([(1, "the thing of and here the ouanment le de la queaux elle mentpa und der die einung verkeit")], DOCS)
    assert [s.lang for s in langid.identify(mixed, model, segments=True).first().segments] == ["en", "fr", "de"]
    assert langid.identify(docs.limit(0), model).count() == 0


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b", None)], DOCS + ", lang string")
    assert langid.train(docs) is None
    assert langid.identify(docs, None).first().lang_pred == "und"


def test_attention_gradient():
    """The analytic gradient of one step equals finite differences of the loss."""
    import pandas as pd

    p = quality.start_parameters()
    rows = pd.DataFrame({"text": ["a b c " * 60, "x | y | z"], "label": [1, 0]})
    word, shape, place, recent, bounds = quality.features(pa.array(rows["text"].tolist()))

    def loss(q):
        first, bags = quality.passages(bounds)
        edges = np.append(first, bounds[-1])
        sums = quality._sum_by(q["Ew"][word[place]] + q["Es"][shape[place]] + q["Er"][recent], edges)
        f = quality.forward(q, sums / np.diff(edges)[:, None], bags)
        return -np.log(f["p"][0]) / 2 - np.log(1 - f["p"][1]) / 2

    seen = {}

    class Spy(quality.Adam):
        def step(self, gradients):
            seen.update({k: v.copy() for k, v in gradients.items()})

    real, quality.Adam = quality.Adam, Spy
    try:
        quality.fit({k: v.copy() for k, v in p.items()}, rows, 0)
    finally:
        quality.Adam = real
    for name in ("c", "w", "V", "U", "bias", "Er"):
        at = np.unravel_index(np.abs(seen[name]).argmax(), seen[name].shape)
        up, down = ({k: v.astype(np.float64) for k, v in p.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        assert seen[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-4, rel=1e-2, abs=1e-5), name


def test_recency_classes():
    codes, bounds = np.array([5, 5, 1, 5, 5, 2]), np.array([0, 4, 6])
    assert quality.recency(codes, bounds).tolist() == [5, 0, 5, 1, 5, 5]


def test_quality_held_out_accuracy_and_odd_rows(spark):
    docs, labels = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "labels")
    model = quality.train(docs, labels)
    out = quality.score(docs, model).where(~is_training_row()).join(labels, "doc_id").toPandas()
    assert (out.predicted == out.quality).mean() > 0.95
    assert out[out.quality == 1].predicted.mean() > 0.97
    odd = quality.score(spark.createDataFrame(ODD, DOCS).selectExpr("*", "'x' as score"), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in odd)
    assert len({r.score for r in odd if not r.text}) == 1
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_without_labels(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    assert quality.train(docs, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_sample_is_bounded_and_deterministic(spark):
    docs = spark.range(500).selectExpr("id as doc", "cast(id as string) as text")
    labels = spark.range(500).selectExpr("id as doc", "if(id < 490, 'hot', 'rare') as label")
    a, b = (sorted(bounded_sample(docs, labels, 20).collect()) for _ in range(2))
    assert a == b and sum(r.label == "hot" for r in a) == 20 and sum(r.label == "rare" for r in a) == 10


def test_a_label_is_learned_with_its_own_row_only(spark):
    rows = [(1, "own text", "en"), (1, "other text", None), (1, "third text", "fr"), (2, None, "en"), (3, "x", None), (None, "y", "en")]
    docs = spark.createDataFrame(rows, "doc long, text string, label string")
    got = {(r.doc, r.text, r.label) for r in bounded_sample(docs, docs, 10).collect()}
    assert got == {(1, "own text", "en"), (1, "third text", "fr"), (2, None, "en")}
    # A row repeated and an id of many rows: bounded, each row once.
    many = spark.range(3000).selectExpr("7L as doc", "concat('t', id % 1000) as text", "'en' as label")
    got = bounded_sample(many, many, 50).collect()
    assert len(got) == 50 and len({r.text for r in got}) == 50
    few = spark.range(300).selectExpr("id as doc", "'t' as text", "concat('l', id % 30) as label")
    assert {r.label for r in bounded_sample(few, few, 2, most_labels=4).collect()} == {"l0", "l1", "l10", "l11"}


def test_posteriors_do_not_depend_on_learning_sums():
    rng = np.random.default_rng(3)
    scores, step, start = (rng.normal(size=n).astype(np.float32) for n in ((5, 3, 4), (4, 4), (4,)))
    a, b = (langid.forward_backward(scores.copy(), step, start, learn=x)[0] for x in (True, False))
    assert np.array_equal(a, b)


def _brute_base(text):
    words = licenses.words_of(text or "")
    hits = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(words), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def _brute_templates(text):
    """Whole notices, by trying every start."""
    words, found = licenses.words_of(text or ""), set()
    for label, template, _ in licenses.TEMPLATES:
        parts = licenses.words_of(template)
        if any(words[i : i + len(parts)] == parts for i in range(len(words) - len(parts) + 1)):
            found.add(label)
    return found


def _notice(label, part):
    return next(text for kind, text, _ in licenses.TEMPLATES if kind == label and part in text)


HEADERS = {
    "mit": """Copyright (c) 2020 Some One\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and
        associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights
        to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as
        published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.""",
    "gpl-2.0": """Foo is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published
        by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
    "lgpl-2.1": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
        License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.""",
    "agpl-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License
        as published by the Free Software Foundation, either version 3 of the License""",
    "apache-2.0": """Licensed to the Some Foundation under one or more contributor license agreements. Licensed under the Apache License, Version 2.0
        (the "License"); you may not use this file except in compliance with the License.""",
    "bsd-3-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.\n3. Neither the name of the Foo Company nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\n License, v. 2.0. If a copy of the MPL was not distributed with this\n file, You can",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above"
           " copyright notice and this permission notice appear in all copies.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell",
}
NEAR_MISSES = [
    "GNU general public licence version 3", "permission is hereby granted to deal in the software", "the Apache project, licensed by its version 2.0",
    "redistribution and use in source and binary forms is forbidden", "This program is free software: you can redistribute it",
    "Permission is hereby granted, free of charge, to any person " + "who asks " * 60 + "without restriction publish distribute sublicense",
    "mozilla public license", "creative commons", "version 3 of the license " + "x " * 200 + "gnu general public license", "the MIT of license",
]


def test_published_notices_are_found_and_near_misses_are_not(spark):
    titles = {"gpl-3.0": "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007", "gpl-2.0": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
              "lgpl-3.0": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", "apache-2.0": "Apache License\n Version 2.0, January 2004\nhttp://www.apache.org/licenses/"}
    asked = [(label, f"{before} {text} {after}") for found in (HEADERS, titles) for label, text in found.items()
             for before, after in (("", ""), ("# word " * 700, "and more " * 300))]
    rows = [(i, text) for i, (_, text) in enumerate(asked)] + [(1000 + i, text) for i, text in enumerate(NEAR_MISSES)]
    filler = [(5000 + i, "the of and software license version to any or in this public general " * 3) for i in range(300)]
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows + filler, DOCS)).collect()}
    for i, (label, text) in enumerate(asked):
        assert label in out[i].labels.split(","), (label, text[:60])
        others = {x for x in out[i].labels.split(",") if x.split("-")[0] in ("gpl", "lgpl", "agpl", "apache", "mpl", "cc")} - {"gpl"}
        assert others <= {label}, (label, others)
    for i, text in enumerate(NEAR_MISSES):
        assert set(filter(None, out[1000 + i].labels.split(","))) <= {"gpl"}, text
    assert all(out[d].labels == "" for d, _ in filler)


def test_licence_scan_matches_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    extra = [
        (10_001, "see: CC-BY, cc by; ALL rights reserved. All rights\nReserved"),
        (10_002, "x " * 500 + _notice("mit", "hereby") + " y" * 500 + " " + _notice("bsd", "Redistribution")),
        (10_007, "x" + _notice("bsd", "Redistribution") + " y" * 500),  # the first word is another one
        (10_003, "GNU general public licence"), (10_004, None), (10_005, ""), (None, "cc by"), (10_001, "cc"),
        (10_006, "Ünder the mît license éall rights reserved"),
    ]
    docs = docs.unionByName(spark.createDataFrame(extra, DOCS))
    out = licenses.scan(docs.selectExpr("*", "1 as n_words", "'z' as labels")).collect()
    texts = sorted([(r.doc_id is None, r.doc_id or 0, _brute_base(r.text)) for r in docs.collect()], key=repr)
    got = sorted(
        [(r.doc_id is None, r.doc_id or 0, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in out], key=repr
    )
    assert got == texts
    labels = {r.doc_id: set(filter(None, r.labels.split(","))) for r in out if r.doc_id != 10_001}
    for r in docs.collect():
        if r.doc_id != 10_001:
            assert labels[r.doc_id] >= _brute_templates(r.text), r.doc_id
    assert {"mit", "bsd"} <= labels[10_002] and "bsd" not in labels[10_007]
    assert all(0 <= r.score <= 1 for r in out)
    assert licenses.scan(docs.limit(0)).count() == 0


def _held_out(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


def test_registered_language_rows(spark):
    out = langid.op1_language_id(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    got = out.collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    languages = {r.lang for r in docs.values() if r.lang}
    for r in got:
        assert r.held_out == _held_out(r.doc_id) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert (r.lang_pred in languages) if letters else (r.lang_pred == "und")
    right = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out and docs[r.doc_id].lang]
    assert sum(right) / len(right) > 0.97


def test_registered_quality_rows(spark):
    out = quality.op2_quality(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = out.collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect())
    assert all(r.held_out == _held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(right) / len(right) > 0.95


def test_registered_licence_rows(spark):
    out = licenses.op4_license_scan(spark, SF)
    kinds = {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint"}
    assert dict(out.dtypes) == kinds | {"base_labels": "string", "labels": "string", "score": "double"}
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(texts)
    for doc, r in got.items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _brute_base(texts[doc]), doc
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels) and 0 <= r.score <= 1


def test_features_of_many_words_stand_in_bounded_memory():
    """the features of all distinct words of a slice stood at once (over 100 MB here)."""
    import tracemalloc

    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17576 % 26)}stuv" for i in range(50_000)]
    model = {
        "W": np.ones((langid.HASHED + 1, 2), np.float32), "T": np.zeros((2, 2), np.float32), "S": np.zeros(2, np.float32),
        "languages": ["a", "b"], "lexicon": {},
    }
    texts = pa.array([" ".join(words[lo : lo + 100]) for lo in range(0, len(words), 100)])
    tracemalloc.start()
    out, bounds = langid.posteriors(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert bounds[-1] == len(words) and np.allclose(out, 0.5)
    assert peak < 50 << 20
