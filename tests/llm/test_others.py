"""Operators 6, 7 and 9, and the pipeline."""

import math

import numpy as np
from pyspark.sql import functions as F

from approxspark.llm import chat, embedding_dedup, license_scan, mixing
from approxspark.sources.tables import table
from conftest import SF_SMALL
from llm_edges import edge_docs  # noqa: F401

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."


def test_licences_and_inheritance(spark):
    rows = [
        (1, "repo/LICENSE", MIT, 0), (2, "repo/a/b/x.py", "print(1)", 0), (3, "repo/a/COPYING", GPL, 0), (4, "repo/y.py", "some\n" + GPL + "\nmore text here of the file", 0),
        (5, "other/z.py", None, 0), (6, None, "", 0), (7, "repo/a/b/w.py", None, 0), (8, "top.py", "the license of a dog", 0), (9, "repo/q/r/s/t.py", "nothing", 0), (9, "repo/q/r/s/t.py", "nothing", 0),
        (None, "repo/n.py", "text " * 50_000 + "\n" + MIT, 0),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string, license int")
    got = {(r["doc_id"], r["path"]): (r["license"], r["origin"], r["from_dir"]) for r in license_scan.scan(files).collect()}
    assert got[1, "repo/LICENSE"] == ("MIT", "file", None) and got[3, "repo/a/COPYING"] == ("GPL-3.0", "file", None)
    assert got[2, "repo/a/b/x.py"] == got[7, "repo/a/b/w.py"] == ("GPL-3.0", "inherited", "repo/a")
    assert got[4, "repo/y.py"] == ("GPL-3.0", "header", None) and got[9, "repo/q/r/s/t.py"] == ("MIT", "inherited", "repo")
    assert got[5, "other/z.py"] == got[6, None] == got[8, "top.py"] == (None, None, None) and got[None, "repo/n.py"] == ("MIT", "header", None)
    assert license_scan.scan(files).count() == len(rows) and license_scan.scan(files.limit(0)).count() == 0


def test_licence_anchors_lose_no_match(spark):
    # against a comparison of every line and text with every template
    import re
    from collections import Counter

    docs = table(spark, SF_SMALL, "documents").select("doc_id", F.lit("p").alias("path"), "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    tok = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    vocabulary = {w for _, t in license_scan.TEMPLATES for w in tok(t)}
    df, n = Counter(w for t in texts.values() for w in vocabulary & set(tok(t))), len(texts)
    vectors, idf = license_scan._vectors(license_scan.TEMPLATES, df, n)

    def score(segment):
        v = {w: (1 + math.log(c)) * idf.get(w, math.log(1 + n) + 1) for w, c in Counter(tok(segment)).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return max(sum(v.get(w, 0) * x for w, x in t.items()) / norm for t in vectors)

    want = {d: round(max(map(score, [t, *re.split(r"\n|(?<=[.!?;])[ \t]+", t)])), 6) for d, t in texts.items()}
    got = {r["doc_id"]: r["score"] for r in license_scan.scan(docs).collect()}
    for d, s in want.items():
        assert (got[d] is None) == (s < 0.7), (d, s, got[d])
        assert got[d] is None or abs(got[d] - s) < 1e-5


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye <|im_end|>"),
        (4, 0, "user", "hi"), (4, 1, "assistant", "hello"), (4, 2, "user", "bye <|im_end|>"), (5, 0, None, None), (6, 0, "user", None), (7, 0, "user", ""),
        (8, None, "system", "x"), (8, 0, "user", "hi"), (9, 0, "user", "a"), (9, 0, "user", "a"), (None, 0, "user", "hi"), (None, 0, "user", "lone"), (None, 0, "user", "lone"),
    ]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    got = {(r["conv_id"], r["chat"]): r for r in chat.format_chats(turns).collect()}
    kept = sorted((-1 if c is None else c) for c, _ in got)
    assert kept == [-1, 3, 5, 6, 7, 8, 9]  # 1 and 2 are prefixes of 3, which 4 equals; the lone turn "hi" is a prefix too
    three = next(r for (c, _), r in got.items() if c == 3)
    assert three["n_copies"] == 2 and three["n_turns"] == 3 and three["chat"].count("<|im_end|>") == 3 and "bye < |im_end|>" in three["chat"]
    assert (5, "<|im_start|>unknown\n<|im_end|>\n") in got and next(r for (c, _), r in got.items() if c == 8)["chat"].startswith("<|im_start|>system")
    assert chat.format_chats(turns.limit(0)).count() == 0


def brute(vectors, least):
    ids = [i for i, _ in vectors]
    m = np.array([v for _, v in vectors], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    link = m @ m.T >= least
    np.fill_diagonal(link, False)
    label = np.arange(len(ids))
    order = np.argsort(ids)
    link, ids = link[np.ix_(order, order)], np.array(ids)[order]
    while True:
        new = np.minimum(label, np.where(link, label[None, :], len(ids)).min(1))
        if (new == label).all():
            return {int(i): (int(n), int(ids[c])) for i, n, c in zip(ids, link.sum(1), label)}
        label = new


def test_vectors_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(400, 24))
    near = base[rng.integers(0, 40, 300)] + 0.05 * rng.normal(size=(300, 24))
    rows = [(i * 3, [float(x) for x in v]) for i, v in enumerate(np.r_[base, near])]
    monkeypatch.setattr(embedding_dedup, "SHARD", 150)  # several shards, split more than once
    monkeypatch.setattr(embedding_dedup, "CENTROIDS", 4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    want = brute(rows, 0.95)
    assert set(got) == set(want)
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert there > 100 and 0.97 * there <= found <= there and all(got[i][0] <= want[i][0] for i in want)


def test_scaled_copies_and_tight_groups_end(spark, monkeypatch):
    # scalings of one vector differ in their last bits; vectors too close together for k-means to split
    rng = np.random.default_rng(8)
    v = rng.normal(size=32)
    scaled = [(i, [float(x) for x in v * s]) for i, s in enumerate(rng.uniform(0.1, 9, 10_000))]
    report: dict = {}
    got = embedding_dedup.near_vectors(spark.createDataFrame(scaled, "vec_id long, embedding array<double>"), report=report).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(9999, 0, 10_000)] and report["drawings"] == 1
    monkeypatch.setattr(embedding_dedup, "SHARD", 150)
    tight = [(i, [float(x) for x in v + 1e-9 * rng.normal(size=32)]) for i in range(700)] + [(1000 + i, [float(x) for x in rng.normal(size=32)]) for i in range(200)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(spark.createDataFrame(tight, "vec_id long, embedding array<double>"), report=report).collect()}
    assert all(got[i] == (699, 0) for i in range(700)) and all(got[1000 + i] == (0, 1000 + i) for i in range(200))
    assert report["recall"]["many"] == 1.0


def test_audit_looks_for_links_and_tells_few_from_many(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(900, 16))
    x = np.r_[base, base[:60] + 0.01 * rng.normal(size=(60, 16)), np.repeat(base[-1:], 80, 0) + 0.01 * rng.normal(size=(80, 16))]
    report: dict = {}
    rows = [(i, [float(e) for e in v]) for i, v in enumerate(x)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), report=report).collect()
    want = brute(rows, 0.95)
    assert report["audited"] == 1024 and report["links"] >= embedding_dedup.AUDIT_LINKS and set(report["recall"]) == {"few", "many"} and min(report["recall"].values()) >= 0.99
    assert {r["vec_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_vector_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, v), (3, v), (4, None), (5, []), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 2.0]),
            (9, [float("inf"), 1.0, 2.0]), (10, [1.0, 2.0]), (None, v), (11, [3.0, -2.0, 1.0]), (12, [1e-300, 2e-300, 3e-300]), (13, [1e300, 2e300, 3e300])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string")
    got = embedding_dedup.near_vectors(df).collect()
    by = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got}
    assert len(got) == len(rows)
    assert by[1] == (5, 1, True) and all(by[i] == (5, 1, False) for i in (2, 3, 12, 13))
    assert all(by[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)) and by[None] == (0, None, True)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_range_search_finds_a_cluster_through_edges():
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(size=(300, 16)), np.repeat(rng.normal(size=(1, 16)), 80, 0) + 0.02 * rng.normal(size=(80, 16))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, b = embedding_dedup._pruned(x, 16, 1.2)
    at, lists = embedding_dedup._neighbours(len(x), a, b)
    q, v = embedding_dedup.range_search(x, at, lists, 0.95)
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.95, 1)))}
    got = set(zip(q.tolist(), v.tolist()))
    assert got <= want and len(got) >= 0.99 * len(want)


def test_pipeline_stages(spark, edge_docs):
    import corpus_pipeline as p

    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for i, (name, stage) in enumerate(p.STAGES):
        docs = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if i < len(p.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        if name == "exact_dedup":
            ids = [r["doc_id"] for r in docs.collect()]
            assert 13 in ids and 2 in ids and 1 not in ids and 11 not in ids and len(ids) == len(set(ids))
        if name == "near_dedup":
            ids = {r["doc_id"] for r in docs.collect()}
            assert {6, 2, 8} <= ids and 7 not in ids and 13 not in ids
    assert docs.count() > 0


def test_pipeline_keeps_clean_documents_and_mixes(spark):
    import corpus_pipeline as p
    from approxspark.llm import language_id, minhash_dedup

    docs = table(spark, SF_SMALL, "documents")
    kept = p.language(spark, docs, SF_SMALL)
    assert kept.count() >= docs.where(F.col("text").rlike(r"\p{L}")).count() - 1
    near = p.near(spark, kept, SF_SMALL)
    assert near.count() == minhash_dedup.near_duplicates(kept).where("kept").count()
    size = lambda d: d.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert abs(size(p.mix(spark, near, SF_SMALL)) - 1.5 * size(near)) <= 40
    assert language_id.held_out() is not None


def test_mixing_stage_emits_whole_documents(spark):
    import corpus_pipeline as p

    # sources whose quota ends within a document, for some of them their only one; lines and a very long text
    rows = [(i, "\n".join(f"w{i} x{j}\ty" for j in range(1 + 37 * i % 400)), "en", f"s{i % 17}", i) for i in range(60)] + [(60, "long\nline " * 20_000, "en", "t", 60), (61, " \n", "en", "t", 61)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in p.mix(spark, docs, SF_SMALL).collect()]
    assert set(got) <= set(rows) and max(map(got.count, set(got))) == 2 and rows[-1] in got
    mixed = mixing.mix(docs, whole=True).collect()
    assert all(r["taken"] % max(1, r["size"]) == 0 for r in mixed)
    for s in {r["sources"][0] for r in mixed}:
        part = [r for r in mixed if r["sources"][0] == s]
        assert abs(sum(r["taken"] for r in part) - int(part[0]["target"])) <= max(r["size"] for r in part) / 2


def test_exact_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as p
    from approxspark.llm import exact_dedup

    rows = [(None, "null ids only", "a"), (None, "null  ids only", "b"), (None, "null ids\nonly", "c"), (7, "x y", "a"), (7, "x y", "b"), (7, "another text", "a"),
            (3, "another text ", "a"), (None, "x y", "a"), (None, "alone", "a"), (8, "more", "a"), (9, "more", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = exact_dedup.exact_dedup(docs).collect()
    by = {}
    for r in found:
        by.setdefault(r["text_sha256"], []).append((r["kept"], r["keep_id"], r["group_size"]))
    assert len(found) == len(rows) and all(sum(k for k, _, _ in g) == 1 and all(n == len(g) for _, _, n in g) for g in by.values())
    got = sorted((r["text"], str(r["doc_id"])) for r in p.exact(spark, docs, SF_SMALL).collect())
    assert got == [("alone", "None"), ("another text ", "3"), ("more", "8"), ("null  ids only", "None"), ("x y", "7")]


def test_wrapped_notices_and_licence_files(spark):
    import textwrap

    full, notice = dict(license_scan.full_texts()), {lic: t for lic, t in reversed(license_scan.NOTICES)}
    mit = full["MIT"].replace("MIT License\n", "MIT License\n\nCopyright (c) 2021 Jane Roe and contributors\n")
    wrapped = lambda lic, mark: mark + " Copyright 2020 Some One\n" + textwrap.indent(textwrap.fill(notice[lic], 70), mark + " ") + "\n\nimport os\nprint(os.getcwd())\n" + "x = compute(y, z)\n" * 50
    body = "def main(argument):\n    return argument * value\n" * 40
    rows = [
        ("m/LICENSE", mit, "MIT", "file"), ("m/src/a.py", "print(1)", "MIT", "inherited"), ("g/COPYING", full["GPL-3.0"], "GPL-3.0", "file"), ("g/a.c", "int x;", "GPL-3.0", "inherited"),
        ("o/COPYING", full["GPL-2.0"], "GPL-2.0", "file"), ("a/LICENSE", full["Apache-2.0"], "Apache-2.0", "file"), ("b/LICENSE", "Copyright 2019 A. B.\n" + full["BSD-3-Clause"], "BSD-3-Clause", "file"),
        ("p/LICENSE", full["MPL-2.0"], "MPL-2.0", "file"), ("h/a.py", wrapped("Apache-2.0", "#"), "Apache-2.0", "header"), ("h/b.c", wrapped("GPL-3.0", " *"), "GPL-3.0", "header"),
        ("h/c.js", wrapped("MPL-2.0", "//"), "MPL-2.0", "header"), ("h/d.sql", wrapped("CC-BY-NC-4.0", "--"), "CC-BY-NC-4.0", "header"), ("h/o.c", wrapped("GPL-2.0", " *"), "GPL-2.0", "header"),
        ("h/e.py", textwrap.indent(mit, "# ") + body, "MIT", "header"), ("h/f.py", "# SPDX-License-Identifier: Apache-2.0\n" + body, "Apache-2.0", "header"),
        ("h/g.py", "# SPDX-License-Identifier: GPL-3.0-or-later\n" + body, "GPL-3.0", "header"), ("h/h.py", "# SPDX-License-Identifier: BSL-1.0\n" + body, None, None), ("h/i.py", body, None, None),
    ]
    files = spark.createDataFrame([(i, p, t) for i, (p, t, _, _) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r["path"]: (r["license"], r["origin"]) for r in license_scan.scan(files).collect()}
    assert got == {p: (lic, origin) for p, _, lic, origin in rows}


def test_stages_go_by_rows_and_keep_clashing_columns(spark):
    import corpus_pipeline as p

    a, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"o{i}" for i in range(60))
    # a near copy under the id of another text, near copies under one id, null ids
    rows = [(1, a), (2, a + " x"), (2, other), (5, a + " y"), (5, a + " z"), (None, a + " n"), (None, "short"), (7, other + " end"), (7, other + " stop")]
    docs = spark.createDataFrame([(d, t, "en", "s", 9, i, "S", 0.5, i + 1, "row", ["x"], "p") for i, (d, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int, `_Row` string, target double, taken int, row string, sources array<string>, _p string")
    near = p.near(spark, docs, SF_SMALL)
    assert near.columns == docs.columns
    assert sorted(str((r["doc_id"], r["text"][:2], r["size"])) for r in near.collect()) == sorted(map(str, [(1, "a0", 0), (2, "o0", 2), (None, "a0", 5), (None, "sh", 6)]))
    want = {tuple(map(str, r)) for r in docs.collect()}
    for stage in (p.exact, p.near, p.mix):
        got = stage(spark, docs, SF_SMALL)
        assert got.columns == docs.columns and {tuple(map(str, r)) for r in got.collect()} <= want


def test_exact_dedup_of_the_least_id(spark):
    from approxspark.llm import exact_dedup

    least = -(2**63)
    rows = [(least, "a b"), (5, "ab"), (None, "a  b"), (5, "x"), (None, "x"), (None, "y")]
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["kept"]) for r in exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(map(str, got.values())) == sorted(map(str, [(None, False), (None, False), (None, True), (5, True), (5, False), (None, True)]))
    assert sum(k for _, k in got.values()) == 3
    tie = exact_dedup.exact_dedup(spark.createDataFrame([(5, "ab"), (least, "ba"[::-1]), (None, "ab")], "doc_id long, text string")).collect()
    assert {r["keep_id"] for r in tie} == {least} and sum(r["kept"] for r in tie) == 1


def test_long_templates_against_brute_force(spark):
    # whole texts and windows at every step of a template's words, compared one by one
    import re
    from collections import Counter

    full = dict(license_scan.full_texts())
    mit, bsd = " ".join(full["MIT"].split()), " ".join(full["BSD-3-Clause"].split())
    filler = "value of the work and other words in a file of code " * 30
    cut = mit.split()
    texts = [filler + mit + " " + filler, mit, filler, filler + " ".join(cut[: len(cut) // 2]) + " " + filler, "x " * 37 + bsd + " y" * 400, full["MPL-2.0"], "", None,
             filler + license_scan.NOTICES[0][1] + filler, " ".join(w for i, w in enumerate(cut) if i % 3) + filler, filler + license_scan.NOTICES[-1][1]]
    files = spark.createDataFrame([(i, f"d{i}/f", t, 1) for i, t in enumerate(texts)], "doc_id long, path string, text string, t int")
    long = (*license_scan.NOTICES, *license_scan.full_texts())
    tok = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    vocabulary = {w for _, t in long for w in tok(t)}
    df, n = Counter(w for t in texts for w in vocabulary & set(tok(t))), len(texts)
    vectors, idf = license_scan._vectors(long, df, n)

    def score(words, v):
        x = {w: (1 + math.log(c)) * idf.get(w, math.log(1 + n) + 1) for w, c in Counter(words).items()}
        return round(sum(x.get(w, 0) * y for w, y in v.items()) / (math.sqrt(sum(z * z for z in x.values())) or 1), 6)

    want = {}
    for i, t in enumerate(texts):
        hits = []
        for (lic, template), v in zip(long, vectors):
            size = len(tok(template))
            w = tok(t)
            hits += [(True, score(w, v), lic)] if w else []
            hits += [(False, score(w[at : at + size], v), lic) for at in range(0, len(w), max(1, size // license_scan.STEPS))]
        best = max([h for h in hits if h[1] >= 0.7], default=None)
        want[i] = best and (best[2], best[1], "file" if best[0] else "header")
    assert want[0][0] == want[1][0] == "MIT" and want[0][2] == "header" and want[1][2] == "file" and want[2] is None and want[4][0] == "BSD-3-Clause"
    got = {r["doc_id"]: r for r in license_scan.scan(files, templates=license_scan.TEMPLATES[:1], long=long).collect()}
    for i, w in want.items():
        g = got[i]
        if w is None:
            assert g["origin"] in (None, "header") and (g["origin"] is None or g["license"] == "Apache-2.0"), (i, g)
        elif w[0] != "Apache-2.0":  # which the one short template also finds
            assert (g["license"], g["origin"]) == (w[0], w[2]) and abs(g["score"] - w[1]) < 1e-5, (i, w, g)
