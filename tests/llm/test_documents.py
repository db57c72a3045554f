"""URL filters, exact dedup, packing, sharding, secrets."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import exact_dedup, packing, secret_scans, sharding, url_filters
from quadrille.llm.queries import RULES, tokenizer_path

URLS = [
    "http://A.example.ORG/es/1", "https://example.org/es", "https://example.org/en/1066?x=/es/", "https://example.org/en/2",
    "http://example.com/fr/", "http://x.y.com/de/a#b", "http://com/de/", "http://notexample.org/es/", "ftp://org", "org/es/",
    "", None, "http://", "http://org?x", "a://b://example.org/es/", "http://example.org/es/\n", "HTTP://EXAMPLE.ORG//es/", "http://é.org/",
]


def judge(url, rules=RULES):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


MANY = RULES + [
    url_filters.Rule("example.org", "/es/1", "allow"), url_filters.Rule("example.org", "/es/1", "block"), url_filters.Rule("a.example.org", "", "block"),
    url_filters.Rule("org", "/en/10", "allow"), url_filters.Rule("y.com", "/de", "allow"),
]


@pytest.mark.parametrize("rules", [RULES, MANY, []])
@pytest.mark.parametrize("most", [1000, 0])
def test_urls_by_trie_and_by_join(spark, rules, most):
    rows = [(i, u, "own") for i, u in enumerate(URLS + URLS)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, Rule string")
    out = url_filters.judge_urls(pages, rules, trie_rules=most if rules else 1000)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: tuple(r)[2:] for r in out.collect()}
    assert found == {i: judge(u, rules) for i, u, _ in rows}


def test_url_rules_from_a_table(spark):
    table = spark.createDataFrame([*RULES, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    for most in (1000, 2):
        found = {r["url"]: (r["rule"], r["verdict"]) for r in url_filters.judge_urls(pages, table, trie_rules=most).collect()}
        assert found == {u: judge(u)[2:] for u in URLS}
    assert url_filters.judge_urls(pages.limit(0), RULES).count() == 0


def test_exact_groups(make_docs, corpus):
    long_ = "ab" * 30_000
    rows = [*corpus, (300, long_ + "c", "aa", "s"), (301, long_ + "d", "aa", "s"), (302, long_ + "c", "aa", "s"), (303, long_, "aa", "s"),
            (304, "a" * 64, "aa", "s"), (305, "a" * 64, "aa", "s"), (306, "a" * 65, "aa", "s"), (307, "é", "aa", "s"), (308, "é", "aa", "s"),
            (308, "é", "aa", "s"), (None, "é", "aa", "s"), (None, "nn", "aa", "s"), (None, "nn", "aa", "s")]
    for first in (64, 3):
        found = exact_dedup.exact_dedup(make_docs(rows, extra=True), first_digit=first).collect()
        groups = defaultdict(list)
        for i, t, _, _ in rows:
            groups[t or ""].append(i)
        expected = Counter()
        for t, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            stays = [keep] + [None] * 0
            for i in ids:
                kept = bool(stays) and i == stays[0]
                if kept:
                    stays.pop()
                expected[i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()] += 1
        assert Counter(tuple(r) for r in found) == expected
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 40, 500)
    where, offset = packing.best_fit(sizes, 64)
    left, plain = [], []
    for i in np.argsort(-sizes, kind="stable"):
        fits = [(c, w) for w, c in enumerate(left) if c >= sizes[i]]
        if fits:
            capacity = min(fits)[0]
            assert 64 - offset[i] == capacity and left[where[i]] == capacity
        else:
            assert offset[i] == 0 and where[i] == len(left)
            left.append(64)
        left[where[i]] -= sizes[i]
        plain.append(i)
    assert min(left) >= 0 and len(left) <= -(-sizes.sum() // 64) + 1


def test_packing_round_trip(make_docs, corpus):
    from tokenizers import Tokenizer

    odd = [(400, "a  b \n c", "aa", "s"), (401, " lead and trail ", "aa", "s"), (402, "x\u00a0y \u2003z\x1c q", "aa", "s"), (403, "it's <|endoftext|> here", "aa", "s")]
    rows = [*corpus, *odd]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    packed = packing.pack_documents(make_docs(rows, extra=True), tokenizer_path(), window=256, group_pieces=50, with_ids=True)
    found = packed.collect()
    expected = Counter()
    for i, t, _, _ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for start in range(0, len(ids), 256):
            piece = struct.pack(f"<{len(ids[start : start + 256])}I", *ids[start : start + 256])
            expected[i, start, len(piece) // 4, zlib.crc32(piece), len(ids), piece] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], bytes(r["ids"])) for r in found) == expected
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 256
    built = {r["sequence_id"]: r for r in packing.sequences(packed, window=256).collect()}
    assert sum(r["used"] for r in built.values()) == sum(r["length"] for r in found)
    for r in built.values():
        whole = r["used"] & (r["used"] - 1) == 0
        assert len(r["ids"]) == 4 * (r["used"] if whole else 256)
    assert packing.pack_documents(make_docs([]), tokenizer_path()).count() == 0


def test_both_ways_to_ids_agree():
    import random

    import numpy as np

    made = packing.encoder(tokenizer_path())
    assert made.fast is not None
    rng, letters = random.Random(1), list("ab's'lX 0é \n\t\r.,!-ß€“…ž_<|>") + ["  ", "the ", "ing", "\u2003", "漢", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        plain = made.tokenizer.encode(text, add_special_tokens=False).ids
        assert made.encode(text) == np.asarray(plain, "<u4").tobytes(), text


def test_other_tokenizer_files_go_the_plain_way():
    import json

    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        assert packing.byte_ranks(json.load(file)) is None
    assert len(packing.encoder(public_tokenizers.path("word_bpe_49k.json")).encode("Some Words")) == 8


def test_narrowed_ids_come_back(spark):
    pieces = [[0], [65535, 0, 7], [65536, 1], [1, 2, 3, 4]]
    raw = [struct.pack(f"<{len(p)}I", *p) for p in pieces]
    assert [len(packing.narrowed(r)) for r in raw] == [2, 6, 8, 8]
    rows = spark.createDataFrame([(i, bytearray(packing.narrowed(r)), len(p)) for i, (r, p) in enumerate(zip(raw, pieces))], "i int, ids binary, n int")
    back = rows.orderBy("i").select(packing.widened(F.col("ids"), F.col("n")).alias("ids")).collect()
    assert [bytes(r["ids"]) for r in back] == raw


def fill(shards, size):
    table, at = [None] * size, {s: 0 for s in shards}
    order = {}
    for s in shards:
        offset, skip = sharding._digest(f"offset:{s}") % size, sharding._digest(f"skip:{s}") % (size - 1) + 1
        order[s] = [(offset + j * skip) % size for j in range(size)]
        assert len(set(order[s])) == size
    while None in table:
        for s in shards:
            while at[s] < size and table[order[s][at[s]]] is not None:
                at[s] += 1
            if at[s] < size:
                table[order[s][at[s]]] = s
    return table


def test_lookup_table(spark, make_docs, corpus):
    shards = [f"s{i}" for i in range(7)]
    table = sharding.fill_table(shards, 101)
    assert [shards[i] for i in table] == fill(shards, 101)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill_table(shards[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 101 // 3
    double = Counter(sharding.fill_table(shards, 101, {"s0": 3}))
    assert double[0] > 2 * double[1]
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 101)
    with pytest.raises(ValueError):
        sharding.fill_table(shards, 100)


def test_rows_find_their_shards(spark, make_docs, corpus):
    shards = [f"s{i}" for i in range(7)]
    docs = make_docs(corpus, extra=True).withColumn("Slot", F.lit("own"))
    out = sharding.assign_shards(docs, ["doc_id"], shards, 101).collect()
    assert len(out) == len(corpus)
    table = sharding.fill_table(shards, 101)
    for r in out:
        key = "-" if r["doc_id"] is None else f"{len(str(r['doc_id']))}:{r['doc_id']}"
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r["slot"], r["shard"]) == (slot, shards[table[slot]])
    assert sharding.assign_shards(make_docs([]), ["doc_id"], shards, 101).count() == 0


def test_written_shards(spark, make_docs, corpus, tmp_path):
    rng = random.Random(2)
    rows = corpus + [(10_000 + i, "".join(rng.choices("abcdefghijklmnop qrstuvwxyz", k=1500)), "aa", "hot") for i in range(1000)] + [(None, None, None, None)] * 3
    placed = sharding.assign_shards(make_docs(rows, parts=32), ["source"], [f"s{i}" for i in range(9)], 101)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "32k")
    try:
        sharding.write_shards(placed, str(tmp_path / "out"))
        sharding.write_shards(placed.limit(0), str(tmp_path / "none"))
    finally:
        spark.conf.unset(key)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r["shard"] for r in back.collect()) == Counter(r["shard"] for r in placed.collect())
    hot = placed.where("source = 'hot'").first()["shard"]
    files = Counter(p.parent.name for p in (tmp_path / "out").rglob("part-*"))
    assert files[f"shard={hot}"] > 8 and max(p.stat().st_size for p in (tmp_path / "out").rglob("part-*")) < 200_000
    assert not list((tmp_path / "none").rglob("shard=*"))


KINDS = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def spans_of(text):
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def test_secret_spans_and_ownership(make_docs):
    own, example = "Zq8" + "tY7kP2mN9vB4xC6w" * 2, "EXAMPLEa1" + "b2C3d4E5f6G7h8J9" * 2
    texts = [
        f"é𝄞 password = 'abcdefghijkl' and {own} end", f"see {example} here", f"Token:{'x' * 12}=secret=short API_KEY: {'q' * 20}", "token: secret: abcdefghijklmnop",
        "AKIA" + "A1" * 7 + " AKIAAKIA" + "Z9" * 6 + " AKIASHORT", "0123456789abcdef0123456789abcdefg deadbeef", f"password={example}", None, "", "plain words only",
        "secret=AKIA" + "B2" * 8, "ab" * 30_000, f"{own}", f"see {example} here",
    ]
    rows = [(i, t, "aa", f"src{i}") for i, t in enumerate(texts)]
    rows[12] = (12, texts[12], "aa", "src0")
    rows += [(3, texts[3], "aa", None), (None, texts[0], "aa", "src0")]
    found = secret_scans.scan_secrets(make_docs(rows, extra=True)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows)
    for i, t, _, _ in rows:
        base, r = spans_of(t), by_id[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [sum(s.startswith(k) for s in base) for k in KINDS] == [r["n_assign"], r["n_access"], r["n_hex"]]
        all_ = r["spans"].split(",") if r["spans"] else []
        assert [s for s in all_ if not s.startswith("owned")] == base
        assert all_ == sorted(all_, key=lambda s: (int(s.split(":")[1]), [*KINDS, "owned"].index(s.split(":")[0])))
    # The owner's token is added wherever it occurs, the widely copied one nowhere; a copied base span is an example.
    assert "owned" in by_id[0]["spans"] and "owned:0" in by_id[12]["spans"] and "owned" not in by_id[1]["spans"]
    assert by_id[0]["n_live"] >= 1 and by_id[6]["spans"].startswith("assign")
    assert secret_scans.scan_secrets(make_docs([])).count() == 0


def test_ownership_counts_distinct_owners_and_repositories(make_docs):
    value = "password=" + "k" * 16
    rows = [(i % 4, value, "aa", f"src{i % 2}") for i in range(12)] + [(9, value, "aa", None)]
    rows = [(i, f"{value} of {n}", lang, src) for n, (i, _, lang, src) in enumerate(rows)]
    rows += rows[:3]  # whole copies count once
    counted = secret_scans.ownership(secret_scans.scan(make_docs(rows))[1]).collect()
    assert [(r["owners"], r["repositories"]) for r in counted] == [(3, 5)]
    found = secret_scans.scan_secrets(make_docs(rows)).collect()
    assert {(r["n_live"], r["n_example"]) for r in found} == {(0, 1)}


def test_secrets_weighed_by_repositories_too(make_docs):
    placeholder, token, shared = "PLACEholder0" + "aB3" * 6, "Zq8" + "tY7kP2mN9vB4xC6w" * 2, "Cd5" + "eF6gH7" * 5
    rows = [(i, f"text {i} has {placeholder} inside", "aa", "hot") for i in range(30)]
    rows += [(100, f"mine is {token} alone", "aa", "src1"), (101, f"mine is {token} alone", "aa", "src2")]
    rows += [(200, f"password={shared}", "aa", "src3"), (201, f"bare {shared} token", "aa", "src4")]
    found = secret_scans.scan_secrets(make_docs(rows, extra=True), most_repositories=5).collect()
    by_id = {r["doc_id"]: (r["spans"], r["n_live"], r["n_example"]) for r in found}
    assert len(found) == len(rows)
    # Many repositories within one owner are a copied example; a copied document is one; kinds are counted together.
    assert all(by_id[i] == ("", 0, 0) for i in range(30))
    assert by_id[100] == by_id[101] == ("owned:8:43", 1, 0)
    assert by_id[200][1:] == (0, 1) and by_id[201] == ("", 0, 0)


def test_a_hundred_thousand_secrets_in_one_text(make_docs):
    part = "password=abcdefghijkl " + "0123456789abcdef "
    text = "é" + part * 50_000
    row = secret_scans.scan_secrets(make_docs([(1, text, "aa", "s"), (2, "none", "aa", "s")])).where("doc_id = 1").first()
    assert (row["n_assign"], row["n_hex"]) == (50_000, 50_000)
    assert row["base_sha256"] == hashlib.sha256(",".join(spans_of(text)).encode()).hexdigest()
