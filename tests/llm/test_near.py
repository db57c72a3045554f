"""Edit join, near duplicates and the classes they share."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import graph, line_dedup, minhash

from .brute import Sets, distance, line_groups, near_groups, shingles


def test_components_follow_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    ring = [(i, 200 + (i - 199) % 20) for i in range(200, 220)]
    found = graph.components(spark.createDataFrame(chain + star + ring, "a bigint, b bigint")).collect()
    groups = Sets()
    for a, b in chain + star + ring:
        groups.join(a, b)
    assert {r["node"]: r["label"] for r in found} == {n: groups.find(n) for n in groups}


def test_linked_classes_lose_no_link_and_compare_few(spark):
    # One dense bucket of 120 mutual copies, one bucket of 60 strangers of whom two (late ones) are linked.
    same = [(1, i) for i in range(120)]
    strangers = [(2, i) for i in range(1000, 1060)]
    asked = []

    def verify(pairs):
        asked.extend((r["a"], r["b"]) for r in pairs.collect())
        return pairs.where("b < 1000 or (a = 1050 and b = 1058)")

    members = spark.createDataFrame(same + strangers, "bucket bigint, node bigint").withColumn("size", F.col("node") % 7)
    classes = graph.linked_classes(members, verify, pairs_per_member=2)
    labels = {r["node"]: r["label"] for r in classes.collect()}
    assert {labels[i] for i in range(120)} == {0} and labels[1058] == 1050
    assert sum(b < 1000 for _, b in asked) == 119 + 118 and len(set(asked)) == len(asked)


def test_linked_classes_of_nothing(spark):
    empty = spark.createDataFrame([], "bucket bigint, node bigint, size bigint")
    assert graph.linked_classes(empty, lambda pairs: pairs) is None


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_bit_parallel_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abé𝄞") for _ in range(rng.randint(edits + 1, 30)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 2)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é", "𝄞b"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    said = df.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), edits).alias("near")).collect()
    for r in said:
        assert r["near"] == (len(r["b"]) > edits and distance(r["a"], r["b"]) <= edits), (r["a"], r["b"])


def test_line_classes_agree_with_all_pairs(make_docs, corpus):
    rows = [(i, t) for i, t, _, _ in corpus]
    docs = make_docs(corpus, extra=True)
    found = line_dedup.find_line_copies(docs).collect()
    lines, groups = line_groups(rows, 2, 20)
    assert Counter((r["doc_id"], r["line_no"], r["chars"]) for r in found) == Counter((rows[i][0], k, len(x)) for (i, k), x in lines.items())
    sizes = Counter(groups.values())
    assert Counter(Counter(r["class_id"] for r in found).values()) == Counter(sizes.values())
    by_id = {r["doc_id"]: r for r in found if r["line_no"] == 0}
    assert by_id[160]["class_id"] != by_id[0]["class_id"]
    kept = defaultdict(int)
    for r in found:
        kept[r["class_id"]] += r["kept"]
    assert set(kept.values()) == {1}
    first = {}
    for (i, k), g in groups.items():
        place = (rows[i][0] is None, rows[i][0] or 0)
        first[g] = min(first.get(g, (place, k)), (place, k))
    keeps = Counter(((r["doc_id"] is None, r["doc_id"] or 0), r["line_no"]) for r in found if r["kept"])
    assert sum(keeps.values()) == len(sizes) and set(first.values()) >= set() and {p for p, _ in keeps} == {p for p, _ in first.values()}


def test_dropping_lines_keeps_documents_and_columns(make_docs, corpus):
    docs = make_docs(corpus, extra=True)
    out = line_dedup.drop_line_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(corpus)
    text = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in (5, None)}
    before = {i: t for i, t, _, _ in corpus}
    assert text[200] is None and text[201] == "" and text[202] == before[202]
    assert text[160] and text[160] in before[160]
    # A whole copy stays for the document-level operator.
    copies = [i for i in range(163, 200) if before[i] in (before[20], before[21], before[22])]
    assert copies and all(text[i] == before[i] for i in copies)


def test_lines_are_cut_into_segments_once(make_docs, corpus, monkeypatch):
    """What looks for shared segments is a written table of numbers, without the lines."""
    met, whole = [], line_dedup.joined_small

    def spy(df, small, on, *rest):
        if on == ["bucket"]:
            met.append((df.columns, bool(df.inputFiles())))
        return whole(df, small, on, *rest)

    monkeypatch.setattr(line_dedup, "joined_small", spy)
    assert line_dedup.find_line_copies(make_docs(corpus)).count() > 0
    assert met == [(["bucket", "h1"], True)]


def test_lines_of_an_empty_table(make_docs):
    assert line_dedup.find_line_copies(make_docs([])).count() == 0
    assert line_dedup.drop_line_copies(make_docs([])).count() == 0


def test_superminhash_estimates_and_stops_early():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for shared in (1500, 2000, 2700):
        a, b = pool[:shared], pool
        both = np.concatenate([a, b])
        owner = np.repeat([0, 1], [len(a), len(b)])
        signed = minhash.signatures(both, owner, 2, 256)
        assert abs((signed[0] == signed[1]).mean() - shared / 3000) < 0.08
    one = minhash.signatures(pool[:1], np.zeros(1, np.int64), 1, 64)
    assert (one[0] < np.iinfo(np.uint64).max).all() and sorted(one[0] >> np.uint64(32)) == list(range(64))


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    sizes = [1, 2, 3, 40, 400, 5, 1000]
    docs = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in sizes]
    whole = minhash.signatures(np.concatenate(docs), np.repeat(np.arange(len(docs)), sizes), len(docs), 64)
    for i, d in enumerate(docs):
        assert (minhash.signatures(d, np.zeros(len(d), np.int64), 1, 64)[0] == whole[i]).all()


@pytest.mark.parametrize("threshold", [80, 85])
def test_near_duplicates_agree_with_all_pairs(make_docs, corpus, threshold):
    rows = [(i, t) for i, t, _, _ in corpus]
    found = minhash.near_duplicates(make_docs(corpus, extra=True), threshold=threshold).collect()
    expected = near_groups(rows, threshold)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found) == Counter(
        (i, n, c, i == c) for (i, _), (n, c) in zip(rows, expected)
    )
    assert sum(not r["kept"] for r in found) > 15


def test_one_document_of_each_group_stays(make_docs, corpus):
    docs = make_docs(corpus, extra=True)
    out = minhash.one_per_group(docs)
    assert out.columns == docs.columns
    texts = [r["text"] for r in out.collect()]
    groups = {}
    rows = [(k, t) for k, (_, t, _, _) in enumerate(corpus)]
    for (k, t), (n, c) in zip(rows, near_groups(rows, 85)):
        groups.setdefault(c if n else ("empty", k), []).append(t)
    assert len(texts) == len(groups)
    assert not [g for g, members in groups.items() if not any(t in members for t in texts)]


def test_near_duplicates_of_an_empty_table(make_docs):
    assert minhash.near_duplicates(make_docs([])).count() == 0
    assert minhash.one_per_group(make_docs([])).count() == 0


def test_shingles_fold_ascii_only():
    memo = minhash._WordHashes()
    same = [len(minhash.shingle_hashes(t, 5, memo)) for t in ("A b c d e f", "a\tB\nc\x0bd e f")]
    assert same == [2, 2] and len(shingles("A b c d e f")) == 2
    first, second = (minhash.shingle_hashes(t, 5, memo).tolist() for t in ("Ä b", "ä b"))
    assert first != second
    assert minhash.shingle_hashes("a\xa0b", 5, memo).tolist() != minhash.shingle_hashes("a b", 5, memo).tolist()
