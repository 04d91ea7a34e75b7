"""Operators that are DataFrame functions only, the set join and the pipeline, against brute force."""

import collections
import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from bisque.llm import common, op01_pii, op02_fingerprints, op03_mixing, op04_sentencepiece, op06_licenses, op09_quality, op10_jaccard

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "x", "a b c", "a b c", "A B c", "long words " * 20_000, "é" * 3000, "two words"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i * 3, t, None if i % 2 else "s", 1.5, "mine") for i, t in enumerate(ODD)] + [(3, "a second text of one id", "s", 0.0, None), (None, "no id", None, None, None)] * 2
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, Labels double, `size` string")


def plans_python(df):
    return [k for k in ("Python", "Pandas", "Arrow") if k in df._jdf.queryExecution().executedPlan().toString()]


# ---- 2


def edited(docs):
    docs = sorted(docs)
    out = {}
    for i, (k, t) in enumerate(docs):
        q = len(t) // 4
        out[k] = t[: len(t) - q] + docs[(i + 1) % len(docs)][1][:q]
    return out


@pytest.mark.parametrize("splits", [None, 7])
def test_edited_texts(spark, splits, monkeypatch):
    if splits:
        whole = op02_fingerprints.next_ids
        monkeypatch.setattr(op02_fingerprints, "next_ids", lambda d: whole(d, splits))
    docs = [(r.doc_id, r.text or "") for r in common.table(spark, SF, "documents").collect()]
    df = op02_fingerprints.query(spark, SF).cache()
    got = {r.doc_id: r for r in df.collect()}
    want = edited(docs)
    assert len(got) == len(docs)
    for k, t in docs:
        assert got[k].n_chars == len(t) and got[k].edited_sha256 == hashlib.sha256(want[k].encode()).hexdigest()
    prints = collections.defaultdict(set)
    for k, t in docs:
        prints[t].add(got[k].fingerprint)
    assert all(len(v) == 1 for v in prints.values())
    near = sum(r.near_edited for r in got.values()) / len(got)
    assert near > 0.3 and near > 5 * sum(r.near_next for r in got.values()) / len(got)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_lexicon_is_the_band(spark):
    docs = spark.createDataFrame([(i, f"all w{i % 5} only{i}") for i in range(100)], "doc_id int, text string")
    bits = op02_fingerprints.lexicon(docs, 0.05, 0.5).first()["bits"]
    on = {64 * i + k for i, b in enumerate(bits) for k in range(64) if b >> k & 1}
    slot = lambda w: xxhash.xxh64_intdigest(w, 42) % (64 * len(bits))
    assert on == {slot(f"w{i}") for i in range(5)}
    assert {r.term % 2**64: r.df for r in op02_fingerprints.band(docs, 0.05, 0.5).collect()} == {xxhash.xxh64_intdigest(f"w{i}", 42): 20 for i in range(5)}


def prints_of(text, on, n_bits):
    """A text's hashes by the docstring: the whole lexicon, then every chain's subset at every rate."""
    signed = lambda h: h - 2**64 if h >> 63 else h
    number = lambda v, size, seed: xxhash.xxh64_intdigest(v.to_bytes(size, "little", signed=True), seed)
    every = {signed(xxhash.xxh64_intdigest(w.lower(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text)}
    kept = {h for h in every if h % n_bits in on}
    kept = sorted(every if len(kept) < op02_fingerprints.FEW else kept)

    def mark(terms):
        h = 42
        for t in terms:
            h = number(t, 8, h)
        return f"{h & 0xFFFF:04x}" if terms else "----"

    out, level = [mark(kept)], [kept] * op02_fingerprints.CHAINS
    for k in range(1, op02_fingerprints.LEVELS + 1):
        level = [[t for t in l if signed(number(j, 4, number(t, 8, 42))) >> 4 * k & 3 == 0] for j, l in enumerate(level)]
        out += map(mark, level)
    return out


def alike(a, b):
    if a == b:
        return 1.0
    n = op02_fingerprints.CHAINS
    for k in range(op02_fingerprints.LEVELS, 0, -1):
        spoken = [x == y for x, y in list(zip(a, b))[1 + n * (k - 1) : 1 + n * k] if (x, y) != ("----", "----")]
        if 2 * len(spoken) >= n:
            return sum(spoken) / len(spoken)
    return float(a[0] == b[0])


def test_fingerprints_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text or "") for r in common.table(spark, SF, "documents").collect())
    df = collections.Counter(w for _, t in docs for w in {x.lower() for x in re.findall(r"[^\x20\x09-\x0D]+", t)})
    band = [w for w, n in df.items() if op02_fingerprints.LOW * len(docs) <= n <= op02_fingerprints.HIGH * len(docs)]
    n_bits = 64 * len(op02_fingerprints.lexicon(common.table(spark, SF, "documents")).first()["bits"])
    assert n_bits >= op02_fingerprints.SPARE * len(band)
    on = {xxhash.xxh64_intdigest(w, 42) % n_bits for w in band}
    want, new = {k: prints_of(t, on, n_bits) for k, t in docs}, {k: prints_of(t, on, n_bits) for k, t in edited(docs).items()}
    after = {k: docs[(i + 1) % len(docs)][0] for i, (k, _) in enumerate(docs)}
    for r in op02_fingerprints.query(spark, SF).collect():
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(want[r.doc_id]), "".join(new[r.doc_id]))
        assert (r.near_edited, r.near_next) == (alike(want[r.doc_id], new[r.doc_id]), alike(want[r.doc_id], want[after[r.doc_id]]))


def test_fingerprints_odd_rows(spark, odd):
    df = op02_fingerprints.edited_neighbours(odd)
    rows = df.collect()
    assert len(rows) == odd.count() and not plans_python(df)
    same = {r.fingerprint for r in rows if r.doc_id in (12, 15, 18)}
    assert len(same) == 1  # equal but for capitals
    assert op02_fingerprints.edited_neighbours(odd.limit(0)).isEmpty()
    one = op02_fingerprints.edited_neighbours(odd.where("doc_id = 12")).first()
    assert one.near_next == 1.0


# ---- 3


def water(sizes, percent=150):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = dict(zip(names, [3, 1, 2] * len(names)))
    left, open_, t = sum(sizes.values()) * percent / 100, set(names), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = {s for s in open_ if unit * w[s] > 2 * sizes[s]}
        if not over:
            t |= {s: unit * w[s] for s in open_}
            break
        for s in over:
            t[s] = 2 * sizes[s]
            left -= t[s]
        open_ -= over
    return t


def test_mixing(spark):
    df = op03_mixing.query(spark, SF)
    rows = df.collect()
    docs = {r.doc_id: r for r in common.table(spark, SF, "documents").collect()}
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for k, r in docs.items()}
    total = collections.Counter()
    for k, r in docs.items():
        total[r.source] += size[k]
    goal = water(total)
    taken, most = collections.Counter(), collections.Counter()
    for r in rows:
        s = docs[r.doc_id].source
        assert (r.size, r.source_size) == (size[r.doc_id], total[s]) and r.target == pytest.approx(goal[s])
        assert 0 <= r.taken <= 2 * r.size and abs(r.taken - r.target / r.source_size * r.size) <= r.size
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    for s in total:
        assert abs(taken[s] - goal[s]) <= most[s] / 2 + 1e-6
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op03_mixing.query(spark, SF).collect())) and not plans_python(df)


def test_rounding_is_fair(spark):
    """Over seeds, a document is taken as often as its share says; small groups force several levels."""
    docs = spark.createDataFrame([(i, "s" if i % 4 else None, " ".join("w" * (1 + i % 5))) for i in range(60)], "doc_id int, source string, text string")
    n, seeds = collections.Counter(), range(12)
    for seed in seeds:
        rows = op03_mixing.mix(docs, seed=seed, group=4, fan_in=2).collect()
        sums = collections.Counter()
        for r in rows:
            n[r.doc_id] += r.copies
            sums[r.source] += r.taken - r.target / r.source_size * r.size
        assert all(abs(v) <= 2.5 + 1e-6 for v in sums.values())
    want = {r.doc_id: r.target / r.source_size for r in rows}
    assert abs(sum(n.values()) / len(seeds) - sum(want.values())) < 2


def test_mixing_odd_rows(spark, odd):
    rows = op03_mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert op03_mixing.mix(odd.limit(0)).isEmpty()
    assert op03_mixing.stage(spark, odd.withColumn("n_chars", F.lit(1)), "").columns == [*odd.columns, "n_chars"]


# ---- 6


def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(op10_jaccard.LOWER))
    at = []
    for p, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        q = p.split()
        at += [(i, label) for i in range(len(w)) if w[i : i + len(q)] == q]
    return len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))


def test_licenses(spark, odd):
    r = random.Random(2)
    words = "under the MIT license Apache license, version 2 CC-BY-NC cc _cc by nc. x é licensedé GPL v3".split()
    made = [r.choice([" ", "\n", "-", "_"]).join(r.choice(words) for _ in range(r.randrange(40))) for _ in range(300)] + ["under the mit license under the mit license", "écc by nc", "cc by nc cc by nc"]
    df = spark.createDataFrame(list(enumerate([*made, *ODD])), "doc_id int, text string").withColumn("labels", F.lit(1))
    out = op06_licenses.scan(df)
    for x in out.collect():
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute_base(x.text), x.text
        assert set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) and 0 <= x.score <= 1
    assert not plans_python(out)
    for x in op06_licenses.query(spark, SF).join(common.table(spark, SF, "documents").select("doc_id", "text"), "doc_id").collect():
        assert (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) == brute_base(x.text)
    assert op06_licenses.scan(odd).count() == odd.count() and op06_licenses.scan(odd.limit(0)).isEmpty()


def brute_rules(text):
    """All rules' intervals over the words, suppressed by containment."""
    norm = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(op10_jaccard.LOWER))) + " "
    hits = [(m.start(), m.end(), r.priority, i, r.label) for i, r in enumerate(op06_licenses.rules()) if r.keyword in norm for m in re.finditer(r.regex, norm)]
    keep = [h for h in hits if not any(o[0] <= h[0] and o[1] >= h[1] and (o[2], o[1] - o[0], -o[3]) > (h[2], h[1] - h[0], -h[3]) for o in hits)]
    return sorted({h[4] for h in keep})


def test_rules_against_brute_force(spark):
    texts = [
        "This work is licensed under the GNU General Public License, version 3.", "Released under the terms of the BSD 3-Clause License and the ISC licence", "SPDX-License-Identifier: Apache-2.0", "GNU Lesser General Public License v2.1, or CC BY-SA 4.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "dedicated to the public domain; All rights reserved", "nothing here", "Mozilla Public License 2.0 licensed under the MIT license", "cc0 1.0 universal, Creative Commons Attribution-NonCommercial 4.0",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for x in op06_licenses.scan(df).collect():
        assert sorted({d.label for d in x.detections}) == brute_rules(x.text), x.text
    assert len(op06_licenses.rules()) > 200


# ---- 10


def brute_join(rows, n, p, q):
    sets, inv, f = {}, collections.defaultdict(list), op10_jaccard.Forest()
    for k, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(op10_jaccard.LOWER))
        sets[k] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    for k in sorted(sets):
        c = collections.Counter()
        for g in sets[k]:
            c.update(inv[g])
            inv[g].append(k)
        for o, m in c.items():
            if q * m >= p * (len(sets[k]) + len(sets[o]) - m):
                f.join(k, o)
    return {k: (len(s), f.find(k)) for k, s in sets.items()}


def near_copies():
    r = random.Random(1)
    rows, k = [], 0
    for g in range(6):
        base = [f"w{r.randrange(400)}" for _ in range(150)]
        for _ in range(40):
            t = list(base)
            for _ in range(r.randrange(0, 7)):
                t[r.randrange(len(t))] = f"e{r.randrange(9000)}"
            rows.append((k, " ".join(t)))
            k += 1
    return rows + [(k + i, t) for i, t in enumerate(["", None, "one", "ONE", "one two", "a b c d"] * 2)]


@pytest.mark.parametrize(("long", "block", "n", "p", "q"), [(48, 1024, 3, 9, 10), (3, 8, 3, 9, 10), (3, 8, 5, 4, 5)])
def test_components_against_brute_force(spark, monkeypatch, long, block, n, p, q):
    monkeypatch.setattr(op10_jaccard, "LONG", long)
    monkeypatch.setattr(op10_jaccard, "BLOCK", block)
    rows = near_copies() + [(r.doc_id + 10_000, r.text) for r in common.table(spark, SF, "documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op10_jaccard.join_components(spark.createDataFrame(rows, "doc_id bigint, text string"), n, p, q).collect()}
    assert got == brute_join(rows, n, p, q)


def test_join_odd_rows(spark, odd):
    rows = op10_jaccard.join_components(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[15].component_id == by[18].component_id == 12 and by[0].component_id == 0 and by[0].n_shingles == 0
    assert op10_jaccard.join_components(odd.limit(0)).isEmpty()


def test_components_of_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 502), (501, 502)], "a bigint, b bigint")
    got = {r.id: r.component for r in op10_jaccard.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500, 502: 500}


# ---- pipeline


def test_pipeline(spark):
    docs = common.table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {k: v[8] for k, r in rows.items() if (v := op09_quality.judge(r.text, op09_quality.Rules()))[7]}
    part = op09_quality.stage(spark, docs, SF)
    assert {r.doc_id: r.text for r in part.collect()} == kept and part.columns == docs.columns
    groups = brute_join(list(kept.items()), 5, 4, 5)
    part = op10_jaccard.stage(spark, part, SF)
    one = {k for k, (_, c) in groups.items() if c == k}
    assert {r.doc_id for r in part.collect()} == one and part.columns == docs.columns
    part = op01_pii.stage(spark, part, SF)
    p = op01_pii.Pseudonyms(b"bisque-default-key")
    texts = {r.doc_id: r.text for r in part.collect()}
    assert texts == {k: p.apply(kept[k])[0] for k in one}
    copies = {r.doc_id: r.copies for r in op03_mixing.mix(part).collect()}
    part = op03_mixing.stage(spark, part, SF)
    assert collections.Counter(r.doc_id for r in part.collect()) == {k: c for k, c in copies.items() if c} and part.columns == docs.columns
    last = op04_sentencepiece.stage(spark, part, SF).collect()
    assert all(r.text == texts[r.doc_id] and r.decodes for r in last)
    ran = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids) for r in ran) == sorted((r.doc_id, r.ids) for r in last)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "pii", "mixing", "sentencepiece"]


def test_mixing_of_repeated_ids(spark):
    """Rows of one id and source with equal and with different sizes, rows without id, sources that look like keys: as many rows out as in."""
    rows = [(7, "a", "w"), (7, "a", "w w"), (7, "a", "w w"), (7, "a", None), (None, "a", "w w w"), (None, "a", "w"), (None, None, "w w"), (None, None, "w w"), (7, "-", "w w"), (7, None, "w w"), (1, "=|1", "w"), (1, "1|", "w"), (1, "", "w")] * 3
    got = op03_mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), group=2, fan_in=2).collect()
    want = collections.Counter((i, s, len((t or "").split())) for i, s, t in rows)
    assert collections.Counter((r.doc_id, r.source, r["size"]) for r in got) == want
    taken, target, most = collections.Counter(), {}, collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        target[r.source], most[r.source] = r.target, max(most[r.source], r["size"])
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 + 1e-6 for s in target)


def test_near_copies_of_odd_rows(spark, odd):
    """Rows told by id, or by id and set where ids are repeated or missing; texts without words stay."""
    got = collections.Counter((r.doc_id, r.text) for r in op10_jaccard.stage(spark, odd, "").collect())
    assert got[(12, "a b c")] == 1 and not any(k in (15, 18) for k, _ in got)  # three copies
    assert got[(3, "a second text of one id")] == 1 and got[(3, None)] == 1 and got[(None, "no id")] == 1 and got[(0, "")] == 1
    assert max(got.values()) == 1
