"""Genetic packing, collocations and the Merkle manifest against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quadrille.llm import collocations, genetic_packing, merkle, packing
from quadrille.llm.queries import tokenizer_path


# -- genetic packing ------------------------------------------------------------------


def test_bound_and_evolution():
    rng = np.random.default_rng(1)
    assert genetic_packing.lower_bound(np.array([600] * 5), 1024) == 5
    assert genetic_packing.lower_bound(np.array([1, 1023, 512, 512]), 1024) == 2
    assert genetic_packing.lower_bound(np.array([700, 700, 400, 400]), 1024) == 3
    for sizes in (rng.integers(1, 1024, 3000), rng.integers(300, 520, 900), np.array([5]), np.full(40, 341)):
        plain = genetic_packing.worth(genetic_packing.best_fit(sizes, np.argsort(-sizes, kind="stable")), sizes)
        pool = genetic_packing.evolve(sizes, [], 3)
        again = genetic_packing.evolve(sizes, [], 3)
        assert all((a == b).all() for a, b in zip(pool, again))
        for packing_ in genetic_packing.evolve(sizes, pool, 4):
            fills = np.bincount(packing_, sizes)
            assert (packing_ >= 0).all() and fills.max() <= 1024 and fills.min() > 0
        assert genetic_packing.worth(pool[0], sizes) <= plain
        assert genetic_packing.worth(pool[0], sizes)[0] >= genetic_packing.lower_bound(sizes)


def test_genetic_packing_round_trip(make_docs, corpus):
    texts = [(t or "") for _, t, _, _ in corpus]
    docs = make_docs([(i, t, lang, s) for i, (_, t, lang, s) in enumerate(corpus)], extra=True)
    made = packing.encoder(tokenizer_path())
    rows = genetic_packing.pack_genetically(docs, tokenizer_path(), problem=60, with_ids=True).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for i, text in enumerate(texts):
        held = sorted(pieces[i], key=lambda r: r["piece"])
        whole = made.encode(text) + np.asarray([2], "<u4").tobytes()
        assert b"".join(r["ids"] for r in held) == whole
        assert len(held) == -(-len(whole) // 4096) and [r["piece"] for r in held] == list(range(len(held)))
        assert all(r["length"] == 1024 for r in held[1:]) and [r["start"] for r in held] == [sum(x["length"] for x in held[:k]) for k in range(len(held))]
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 1024
    none = genetic_packing.pack_genetically(make_docs([]), tokenizer_path())
    assert none.count() == 0
    same = genetic_packing.pack_genetically(make_docs([(None, None, None, None)] * 3 + [(7, "", "aa", "s")] * 2), tokenizer_path()).collect()
    assert [r["length"] for r in same] == [1] * 5 and len({r["sequence_id"] for r in same}) == 1


# -- collocations ---------------------------------------------------------------------


def plain_phrases(rows, least, longest, top, subsumed=100):
    found, total = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                found[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in found.items():
        cand = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        kept = []
        for p, a in cand.items():
            inside = any(len(x) > len(p) and 100 * n >= subsumed * a and any(x[i : i + len(p)] == p for i in range(len(x))) for x, n in cand.items())
            if inside:
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("part", [collocations.PART, 3])
def test_phrases(make_docs, part, monkeypatch):
    rng = random.Random(8)
    fixed = ["New York City hall", "new  york\tcity", "zur Zeit die Ärzte", "a b a b a b a", "x y z w v", "x y z w v u"]
    rows = []
    for i in range(300):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choice("abcdexyz") for _ in range(rng.randint(0, 9))) for _ in range(8)]
        rows.append((i, "".join(p + rng.choice([" ", ". ", "\n", "\r", ",", "  "]) for p in parts), rng.choice(["aa", "aa", "b b", None, "und"]), "s"))
    rows += [(1, rows[1][1], "aa", "s"), (None, None, "aa", "s"), (300, "", None, None), (301, "?!\n\t ", "cc", "s"), (302, "a b " * 20_000, "dd", "s"), (303, "é" * 40_000, "dd", "s")]
    # Small blocks and parts: the same counts.
    monkeypatch.setattr(collocations, "BLOCK", 2_000)
    monkeypatch.setattr(collocations, "BATCH_BYTES", 4_000)
    learn = collocations.learn
    monkeypatch.setattr(collocations, "learn", lambda f, _=None: learn(f, part))
    for least, longest, top in ((20, 5, 2000), (8, 3, 5)):
        found = collocations.mine_phrases(make_docs(rows, extra=True), least, longest, top)
        assert sorted(map(tuple, found.collect())) == plain_phrases(rows, least, longest, top)
    assert collocations.mine_phrases(make_docs([])).count() == 0
    assert collocations.mine_phrases(make_docs(rows[:3])).count() == 0


def test_words_are_cut_as_the_pattern_cuts():
    texts = ["Ab  c\td.e", "", " ,", "é x\nY z", "w" * 5000, "q"]
    words, text, piece = collocations.cut_words(pa.array(["skip me", *texts]).slice(1))
    want = [(i, w.lower() if w.isascii() else w.replace("Y", "y")) for i, t in enumerate(texts) for p in re.split(r"[.,;:!?\x0A-\x0D]", t) for w in re.findall(r"[^\x20\x09]+", p)]
    assert list(zip(text.tolist(), words.to_pylist())) == want
    said = iter(piece.tolist())
    groups = [[next(said) for _ in re.findall(r"[^\x20\x09]+", p)] for t in texts for p in re.split(r"[.,;:!?\x0A-\x0D]", t)]
    groups = [g for g in groups if g]
    assert all(len(set(g)) == 1 for g in groups) and len({g[0] for g in groups}) == len(groups)


def test_frequent_phrases_are_always_known(spark):
    phrases = [("aa", f"w{i} x{i % 7}", 10**i) for i in range(12)]
    known = collocations.learn(spark.createDataFrame(phrases, "lang string, phrase string, f bigint"))
    hashes = collocations.phrase_hashes(
        np.repeat(collocations.word_hashes(pa.array(["aa"])), 12), [collocations.word_hashes(pa.array([p.split()[k] for _, p, _ in phrases])) for k in (0, 1)]
    )
    assert known.frequent(hashes).all() and not known.frequent(hashes + np.uint64(1 << 50)).all()
    assert all(n * collocations.PART >= f for n, (_, _, f) in zip(known.parts(hashes), phrases))


# -- Merkle manifest ------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_audit(rows, altered, fanout):
    def leaf(row):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for g, s in enumerate(names):
        for i, row in enumerate(groups[s]):
            claimed, proof = leaf(altered(row)), ""
            for levels, place in ((trees[s], i), (top, g)):
                for level in levels[:-1]:
                    first = place // fanout * fanout
                    run = level[first : first + fanout]
                    left, right = "".join(run[: place - first]), "".join(run[place - first + 1 :])
                    claimed, proof, place = h(left, claimed, right), proof + left + right, place // fanout
            out.append((row[0], leaf(row), trees[s][-1][0], top[-1][0], h(proof), claimed, claimed == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [[1], [16, 17], [300, 1, 5], [4100], [1] * 40])
def test_manifest(make_docs, corpus, sizes):
    rows, n = [], 0
    for g, size in enumerate(sizes):
        for k in range(size):
            text = corpus[n % len(corpus)][1]
            rows.append((n, None if text is None else text[:200], "aa" if n % 3 else None, None if g == 1 else f"sé{g}" if g % 2 else f"z{g}"))
            n += 1
    rows += [rows[0], rows[0], (None, rows[0][1], None, rows[0][3]), (0, "other", "aa", rows[0][3])]
    docs = make_docs(rows, extra=True)
    text = F.when(F.col("doc_id") % 5 == 0, F.upper("text")).otherwise(F.col("text"))
    got = sorted(map(tuple, merkle.audit(docs, {"text": text}).collect()), key=str)
    full = [(i, s, lang, None if t is None else len(t), t) for i, t, lang, s in rows]

    def altered(row):
        return (*row[:4], row[4].upper()) if row[0] is not None and row[0] % 5 == 0 and row[4] is not None else row

    # Python and Java agree on capitals of these texts.
    assert got == plain_audit(full, altered, merkle.FANOUT)


def test_manifest_of_nothing_and_of_narrow_runs(make_docs, corpus):
    assert merkle.audit(make_docs([]), {}).count() == 0
    rows = [(i, t, lang, s) for i, (_, t, lang, s) in enumerate(corpus[:60]) if len(t or "") < 5000]
    found = merkle.manifest(make_docs(rows), fanout=2)
    folded = found.select((merkle.fold(F.col("claimed"), F.col("steps")) == F.col("root")).alias("ok"), F.size("steps").alias("n")).collect()
    assert all(r["ok"] for r in folded) and max(r["n"] for r in folded) > 5
    with pytest.raises(ValueError):
        merkle.climb(make_docs([]).selectExpr("'' as grp", "1L as pos", "1L as n", "'' as hash"), fanout=3)
