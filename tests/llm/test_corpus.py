"""Language ID, mixing, quality rules, the pipeline and the registered queries."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import language_id, mixing, quality_rules
from quadrille.llm.queries import QUERIES, SQL

from .brute import WORD
from .conftest import words

ROOT = "/root/testdata/sf0.001"


def test_bloom_slices_return_every_language_and_chance_is_corrected():
    rng = np.random.default_rng(1)
    names = [f"l{i}" for i in range(70)]  # more than one word of bits
    grams = {n: rng.integers(0, 2**63, 300, dtype=np.uint64) for n in names}
    model = language_id.build_model(names, grams, slots=1 << 12)
    for i, n in enumerate(names):
        found = model.hits(grams[n])
        assert ((found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    strange = model.hits(rng.integers(0, 2**63, 20_000, dtype=np.uint64))
    for i in (0, 69):
        chance = ((strange[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
        assert abs(chance - model.chance[i]) < 0.01


def test_grams_are_the_same_alone_and_in_a_batch():
    texts = ["Ab cd", "", "Éé 1 x", "  ", "abc"]
    whole, owner, letters = language_id.text_grams(texts)
    assert letters.tolist() == [True, False, True, False, True]
    for i, t in enumerate(texts):
        assert language_id.text_grams([t])[0].tolist() == whole[owner == i].tolist()
    assert language_id.text_grams(["AB CD"])[0].tolist() == whole[owner == 0].tolist()


def test_languages_of_a_corpus(make_docs, corpus):
    found = language_id.identify(make_docs(corpus, extra=True), least_share=0.01).collect()
    assert len(found) == len(corpus)
    truth = {i: lang for i, _, lang, _ in corpus}
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (200, 201, 202, 203):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif r["doc_id"] is not None and r["doc_id"] < 200 and r["doc_id"] != 5:  # 5 is two different texts
            assert r["lang_pred"] == truth[r["doc_id"]] and r["score"] > 0.5
    assert sum(r["held_out"] for r in found) > 20 and not [r for r in found if r["doc_id"] is None and r["held_out"]]


def test_languages_without_rows_or_labels(make_docs):
    assert language_id.identify(make_docs([])).count() == 0
    rows = [(1, "some words", None, "s"), (2, None, "aa", "s")]
    assert {(r["lang_pred"], r["score"]) for r in language_id.identify(make_docs(rows)).collect()} == {("und", 0.0)}


@pytest.mark.parametrize("most", [20, 3000])
def test_copies_weigh_as_one_document(make_docs, most):
    rng = random.Random(8)
    rows = [(i, words(rng, 40, ["ka", "lo", "mi", "ten", "su", "ra"]), "aa", "s") for i in range(60)]
    copies = [(100 + i, rows[3][1], "aa", "s") for i in range(600)] + [(900 + i, rows[4][1], "aa", "s") for i in range(600)]
    # A language whose name differs is another document even with the same text.
    rows.append((99, rows[5][1], "bb", "s"))
    plain, full = (language_id.fit(make_docs(r), docs_per_language=most, least_share=0.05) for r in (rows, rows + copies))
    assert plain.languages == full.languages == ["aa", "bb"] and (plain.table == full.table).all()


def test_prediction_keeps_columns(make_docs, corpus):
    docs = make_docs(corpus, extra=True)
    out = language_id.predict(docs, language_id.fit(docs), pred="LANG_PRED")
    assert out.columns == [c for c in docs.columns if c not in ("score", "lang_pred")] + ["LANG_PRED", "score"]
    assert Counter(r["text"] for r in out.collect()) == Counter(t for _, t, _, _ in corpus)


def targets_of(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(most * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_fill_up_to_the_bound(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000, 10**6]) for i in range(9)} | {None: 70, "é": 3, "Z": 400}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    expected = targets_of(sizes)
    assert found.keys() == expected.keys()
    for s, t in expected.items():
        assert found[s] == pytest.approx(t, abs=1e-5)


def mix_rows(rng):
    rows = [(i, words(rng, rng.randint(1, 60), ["ka", "lo#", "mi"]), "aa", rng.choice(["a", "b", "b", "b", "c", "d"])) for i in range(600)]
    rows += [(700 + i, None, "aa", "a") for i in range(3)] + [(710, "", "aa", None), (711, "one two three", "aa", None), (None, "x y", "aa", "a")]
    return rows + [(800, "same row here", "aa", "e")] * 40


def test_mix_meets_targets_like_a_sorted_prefix(make_docs):
    rows = mix_rows(random.Random(2))
    docs = make_docs(rows, extra=True)
    found = mixing.mix_documents(docs, ranges=8, in_order=3).collect()
    assert len(found) == len(rows)
    again = mixing.mix_documents(docs.repartition(7), in_order=10_000).collect()
    plain = lambda rs: Counter((r["doc_id"], r["source"], r["size"], r["target"], r["taken"]) for r in rs)
    assert plain(found) == plain(again)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    expected = targets_of(sizes)
    for s, t in expected.items():
        longest = max(r["size"] for r in found if r["source"] == s)
        assert abs(taken[s] - t) <= longest / 2 + 1
        epochs = {r["taken"] // r["size"] for r in found if r["source"] == s and r["size"]}
        assert max(epochs) - min(epochs) <= 1
    assert {r["size"] for r in found if r["doc_id"] in (700, 701, 702, 710)} == {0}


def test_quality_scales_the_draw(make_docs):
    rows = [(i, "w " * 10 + ("good" if i % 2 else "poor"), "aa", f"s{i % 3}") for i in range(900)]
    quality = F.when(F.col("text").endswith("good"), 4.0).otherwise(0.5)
    found = mixing.mix_documents(make_docs(rows), weights=(1.0, 1.0, 1.0), total_share=0.5, quality=quality).collect()
    took = Counter(r["doc_id"] % 2 for r in found if r["taken"])
    assert took[1] > 2.5 * took[0]


def test_no_source_leaves_many_rows_to_one_task(spark):
    """Sources of poor documents alone, of one repeated row, of a few keys far apart, and of one row."""
    rows = [("poor", 3, -math.log(u) / 0.001) for u in [(i + 0.5) / 3000 for i in range(3000)]]
    rows += [("same", 2, 5.0)] * 3000 + [("apart", 1, 10.0 ** (i % 300 - 150)) for i in range(3000)] + [(None, 7, 1.0), ("empty", 0, 1.0)]
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "source string, size bigint, key double, __row bigint")
    budgets = {"poor": 4000.0, "same": 3001.0, "apart": 1500.0, None: 3.0, "empty": 0.0}
    plan = spark.createDataFrame(list(budgets.items()), "source string, budget double")
    for end in mixing.budget_ends(table, plan, ranges=16, in_order=20).collect():
        ordered = sorted((k, i, n) for i, (s, n, k) in enumerate(rows) if s == end["source"])
        ahead = [r for r in ordered if (r[0], r[1]) < (end["low"], end["first"])] if end["low"] == end["high"] else [r for r in ordered if r[0] < end["low"]]
        inside = [r for r in ordered if end["low"] <= r[0] <= end["high"] and end["first"] <= r[1] <= end["last"]]
        assert len(inside) == end["held"] <= 20 and ordered[len(ahead) : len(ahead) + len(inside)] == inside
        size = sum(r[2] for r in ahead)
        assert size == end["before"] <= budgets[end["source"]] < size + sum(r[2] for r in inside) + (not inside[-1][2])


def test_the_mix_repeats_whole_rows(make_docs):
    rows = mix_rows(random.Random(3))
    docs = make_docs(rows, extra=True)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    counted = Counter((r["doc_id"], r["text"]) for r in out.collect())
    plan = mixing.mix_documents(docs).collect()
    assert sum(counted.values()) == sum(r["taken"] // r["size"] for r in plan if r["size"])
    assert mixing.mix_documents(make_docs([])).count() == 0 and mixing.mixed_documents(make_docs([])).count() == 0


def test_binomial_bound_is_exact():
    for n, risk, delta in [(10, 0.1, 0.05), (100, 0.05, 0.01), (299, 0.01, 0.05), (298, 0.01, 0.05), (1000, 0.02, 0.001), (0, 0.1, 0.1)]:
        chance = [math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(n + 1)]
        allowed = [k for k in range(n + 1) if sum(chance[: k + 1]) <= delta]
        assert quality_rules.most_rejected(n, risk, delta) == max(allowed, default=-1)


def measures_of(text):
    found = WORD.findall(text)
    triples = Counter(zip(found, found[1:], found[2:]))
    covered = {j for i in range(len(found) - 2) if triples[tuple(found[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures(corpus):
    texts = [t or "" for _, t, _, _ in corpus if len(t or "") < 10**5]
    texts += ["a b a b a b", "a b c a b c d", "x\nx\n\n \n\ny\nx", "a\xa0b\u2003c\x1cd\x85e", "#é*𝄞 <>", "a a a a"]
    for t in texts:
        assert quality_rules.measure(t)[:5] == measures_of(t), t[:80]


def test_cutoffs_keep_good_documents(spark, make_docs):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        body = words(rng, 70, ["ka", "lo", "mi", "ten", "su", "ra"])
        if bad:
            body = " ".join(w + "#" * 8 for w in body.split())
        rows.append((i, body, "aa" if i % 2 else None, "s"))
        if i < 2000:
            labels.append((i, 0 if bad else 1))
    rows += [(9000, None, "aa", "s"), (9001, "short", "zz", "s"), (9002, rows[0][1], "zz", "s"), (None, rows[1][1], "aa", "s"), (1, rows[1][1], "aa", "s")]
    labelled = spark.createDataFrame(labels + [(None, 1), (5, None), (7, 1), (7, 1)], "doc_id bigint, quality int")
    found = quality_rules.judge_quality(make_docs(rows, extra=True), labelled, risk=0.02).collect()
    assert len(found) == len(rows)
    verdicts = defaultdict(Counter)
    for r in found:
        if r["doc_id"] is not None and r["doc_id"] < 3000:
            verdicts["bad" if r["doc_id"] % 5 == 0 else "good"][r["kept"]] += 1
    assert verdicts["good"][False] <= 0.02 * verdicts["good"].total() and verdicts["bad"][True] == 0
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[9000]["base_failed"] and by_id[9001]["base_failed"] and by_id[9000]["n_words"] == 0
    assert by_id[9002]["kept"]  # a stratum without labels has no cutoffs
    few = quality_rules.judge_quality(make_docs(rows), labelled.limit(20)).collect()
    assert all(r["kept"] != r["base_failed"] for r in few)
    assert quality_rules.judge_quality(make_docs([]), labelled).count() == 0


def test_stages_of_the_pipeline(spark, make_docs, corpus):
    import corpus_pipeline as p
    from quadrille.session import stage

    assert [n for n, _ in p.STAGES] == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    docs = make_docs([r for r in corpus if r[0] != 206])
    seen = [docs]
    for _, step in p.STAGES:
        seen.append(stage(step(spark, seen[-1], ROOT)))
    for out in seen[1:-1]:
        assert out.columns == docs.columns
    ids = [Counter(r["doc_id"] for r in out.select("doc_id").collect()) for out in seen[:-1]]
    assert set(ids[0]) - set(ids[1]) >= {200, 201, 202, 203} and not set(range(160)) - set(ids[1])
    assert ids[1] == ids[2]
    assert not ids[3] - ids[2] and sum(ids[3].values()) < sum(ids[2].values())
    assert set(ids[4]) <= set(ids[3]) and all(n <= 2 * ids[3][i] for i, n in ids[4].items())
    packed = seen[-1].collect()
    whole = Counter()
    for r in packed:
        whole[r["doc_id"]] += r["start"] == 0
    assert whole == ids[4]
    for step in p.STAGES:
        assert step[1](spark, docs.limit(0), ROOT).count() == 0


def test_near_stage_misses_no_more_than_the_query(make_docs, corpus, monkeypatch):
    import corpus_pipeline as p
    from quadrille.llm import minhash

    asked, near = [], minhash.near_duplicates
    monkeypatch.setattr(minhash, "near_duplicates", lambda docs, **o: asked.append(o) or near(docs, **o))
    assert p.dedup_documents(None, make_docs(corpus), ROOT).count() > 0
    missed = [
        (1 - (o.get("threshold", minhash.THRESHOLD) / 100) ** o.get("rows", minhash.ROWS)) ** o.get("bands", minhash.BANDS) for o in [*asked, {}]
    ]
    assert len(asked) == 1 and asked[0]["threshold"] == 80 and missed[0] <= missed[1]


def test_last_stage_returns_the_training_data(spark, make_docs, corpus):
    import corpus_pipeline as p
    from quadrille.llm import packing

    docs = make_docs([r for r in corpus if r[0] is not None and r[0] < 40])
    packed = p.pack(spark, docs, ROOT)
    made = packing.encoder(p.tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] != 5}
    held = defaultdict(dict)
    for r in packed.collect():
        held[r["doc_id"]][r["start"]] = r["ids"]
    for i, text in texts.items():
        assert b"".join(held[i][s] for s in sorted(held[i]))[:-4] == made.encode(text)
    rows = packing.sequences(packed).collect()
    assert rows and all(len(r["ids"]) >= 4 * r["used"] for r in rows)


def test_sharding_places_whole_documents(spark):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    rows = QUERIES["op7_sharding"](spark, ROOT).collect()
    assert len(rows) == len(docs)
    sizes = Counter()
    for r in rows:
        text = docs[r["doc_id"]]
        raw = (text or "").encode()
        assert (r["text_bytes"], r["text_md5"]) == (len(raw), None if text is None else hashlib.md5(raw).hexdigest())
        sizes[r["shard"]] += len(raw)
    assert all(sizes[r["shard"]] == r["shard_bytes"] for r in rows)


def test_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names
    assert set(SQL) <= set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    from check import compare, connect

    assert compare(QUERIES[name](spark, ROOT), connect(ROOT), SQL[name]) == "ok"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() >= 200


def test_texts_reach_python_in_bounded_batches(spark, make_docs):
    """60 texts of 200,000 bytes in one partition are 12 MB; no batch is larger than its bound and one row."""
    import pyarrow as pa

    from quadrille.llm import common, genetic_packing, minhash, packing
    from quadrille.llm.queries import tokenizer_path

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = make_docs([(i, f"{i} " + "sun lo mi " * 20_000, "aa", "s") for i in range(60)], parts=1)
    rows = docs.selectExpr("doc_id", "doc_id AS handle", "doc_id AS __row", "text")
    model = language_id.build_model(["aa"], {})
    calls = [
        lambda: language_id.predict(docs, model),
        lambda: minhash.sign(rows, 5, 16, 4),
        lambda: minhash.shingle_sets(rows.selectExpr("doc_id AS node", "binary('') AS set_key", "text"), 5),
        lambda: packing.cut_pieces(rows, tokenizer_path()),
        lambda: genetic_packing.cut_pieces(rows, tokenizer_path()),
    ]
    for call in calls:
        spark.conf.unset(key)
        call()
        assert int(spark.conf.get(key)) == common.ARROW_BYTES

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes], "n": [batch.num_rows]})

    found = common.bounded_batches(docs).mapInArrow(sizes, "bytes bigint, n bigint").collect()
    assert sum(r["n"] for r in found) == 60
    assert max(r["bytes"] for r in found) < common.ARROW_BYTES + 300_000
    # A text goes to Python once: the plan asks for no second column of it.
    plan = language_id.predict(docs, model)._jdf.queryExecution().optimizedPlan().toString()
    assert "__text" not in plan
    spark.conf.set(key, "1000000")
    assert common.bounded_batches(docs) is docs and spark.conf.get(key) == "1000000"
    spark.conf.unset(key)


def test_language_fit_is_the_same_in_any_runs(make_docs, corpus, monkeypatch):
    docs = make_docs(corpus)
    whole = language_id.fit(docs)
    monkeypatch.setattr(language_id, "CHUNK_GRAMS", 50)
    parts = language_id.fit(docs)
    assert whole.languages == parts.languages and (whole.table == parts.table).all() and (whole.chance == parts.chance).all()
