"""The queries that SQL cannot express, against brute force over whole small tables; and what else they promise."""

import hashlib
import json
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash

import corpus_pipeline
from ticklore.llm import queries, topk
from ticklore.llm.common import keyed, table
from ticklore.llm.simhash_dedup import near_dedup

SF, SF_LABELS = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
BLANK = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def words_of(text, lower=False):
    b = (text or "").encode()
    return BLANK.findall(b.lower() if lower else b)


def rows(spark, name, sf=SF):
    return queries.QUERIES[name](spark, sf).collect()


@pytest.fixture(scope="module")
def texts():
    return {i: t or "" for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()}


@pytest.fixture(scope="module")
def items():
    return dict(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    want = con.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    assert sorted(map(tuple, got[cols].values.tolist())) == sorted(map(tuple, want[cols].values.tolist()))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def plain(text):
    return re.findall(r"\w+", (text or "").lower())


def test_decontamination(spark, texts, items):
    got = {(r.doc_id, r.item_id) for r in rows(spark, "op1_decontamination")}
    joined = {i: " " + " ".join(plain(t)) + " " for i, t in texts.items()}
    verbatim = {(d, i) for i, t in items.items() for d, j in joined.items() if " " + " ".join(plain(t)) + " " in j}
    assert verbatim and verbatim <= got
    for d, i in got:
        # Whole-document subsequence: no region has a longer one.
        assert lcs(plain(items[i]), plain(texts[d])) >= 0.6 * len(plain(items[i]))


@pytest.mark.parametrize("shard_bytes", [1 << 30, 40_000])
def test_top_k(spark, texts, monkeypatch, shard_bytes):
    monkeypatch.setattr(topk, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(topk, "BLOCK_TERMS", 700)
    docs = keyed(table(spark, SF, "documents"))
    got = defaultdict(list)
    for r in topk.top_k(docs, docs.filter("doc_id % 50 = 0"), 10).collect():
        got[r.query_id].append((r.rank, r.doc_id, r.score))
    bags = {d: Counter(words_of(t, True)) for d, t in texts.items()}
    lens = {d: sum(b.values()) for d, b in bags.items()}
    mean, df = sum(lens.values()) / len(lens), Counter(w for b in bags.values() for w in b)
    idf = {w: math.log(1 + (len(bags) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    for q in (d for d in texts if d % 50 == 0):
        score = {d: sum(n * idf[w] * b[w] * (topk.K1 + 1) / (b[w] + topk.K1 * (1 - topk.B + topk.B * lens[d] / mean)) for w, n in bags[q].items() if w in b) for d, b in bags.items()}
        best = sorted((s for s in score.values() if s > 0), reverse=True)[:10]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert [s for _, _, s in own] == pytest.approx(best, rel=1e-5)
        assert [s for _, _, s in own] == pytest.approx([score[d] for _, d, _ in own], rel=1e-5)


def test_simhash(spark, texts):
    def fingerprint(text):
        w = words_of(text, True)
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {d: fingerprint(t) for d, t in texts.items()}
    top = {d: d for d in fp}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op4_simhash_dedup")}
    assert got == {d: (f"{fp[d]:016x}", find(d)) for d in fp}


def test_substring(spark, texts):
    w = {d: words_of(t) for d, t in texts.items()}
    seen = Counter(tuple(x[i : i + 35]) for x in w.values() for i in range(len(x) - 34))
    want = {}
    for d, x in w.items():
        gone = {j for i in range(len(x) - 34) if seen[tuple(x[i : i + 35])] > 1 for j in range(i, i + 35)}
        want[d] = (len(x), len(gone), sha(b" ".join(y for j, y in enumerate(x) if j not in gone)))
    assert any(x[1] for x in want.values())
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op5_substring_dedup")} == want


def test_suffix(spark, texts):
    seen, want = set(), {}
    for d in sorted(texts):
        b = texts[d].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            s = xxhash.xxh3_128_digest(b[i : i + 100])
            if s in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(s)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        want[d] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    assert any(x[1] for x in want.values())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op10_suffix_dedup")} == want


def check_pieces(pieces, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for d, own in by_doc.items():
        ids = [*made.encode(texts[d] or "", add_special_tokens=False).ids, 0]
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for own in by_seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    assert len(by_seq) == -(-sum(r.length for r in pieces) // 1024)


def test_packing(spark, texts):
    check_pieces(rows(spark, "op7_curve_packing"), texts)


def test_toxicity(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF_LABELS}/labels.parquet'").fetchall())
    got = {r.doc_id: r for r in rows(spark, "op8_toxicity", SF_LABELS)}
    assert len(got) == len(duckdb.sql(f"SELECT doc_id FROM '{SF_LABELS}/documents.parquet'").fetchall())
    for d, r in got.items():
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
    held = [(got[d].predicted, y) for d, y in labels.items() if d in got and got[d].held_out]
    assert sum(p == y for p, y in held) >= 0.9 * len(held)
    assert not any(p and not y for p, y in held)


def test_lm(spark, texts):
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    toks = {d: [*words_of(t, True), b"\0end"] for d, t in texts.items()}
    c = Counter(w for d, x in toks.items() if not held[d] for w in x)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in rows(spark, "op9_deleted_interpolation")}
    assert set(got) == set(texts)
    for d, x in toks.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(x), sum(w in c for w in x), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), rel=1e-9)
        assert r.score <= 0
    # The learned mixture says held-out texts better than the base does.
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


#: Two standard errors of a similarity of 0.8 told from 256 hashes.


def shingles(text):
    w = words_of(text, True)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_dedup(spark, texts):
    named = {r.doc_id: r.component_id for r in near_dedup(table(spark, SF, "documents")).collect()}
    sets = {d: shingles(t) for d, t in texts.items()}
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                assert named[a] == named[b], (a, b)


def test_pipeline(spark, texts, items):
    """Each stage by brute force on what the stage before kept."""
    docs = table(spark, SF, "documents")
    kept, before = dict(texts), set(texts)
    toxic = {r.doc_id for r in rows(spark, "op8_toxicity") if r.predicted}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        if name == "packing":
            check_pieces(docs.collect(), kept)
            break
        assert docs.columns == table(spark, SF, "documents").columns
        own = {r.doc_id: r.text or "" for r in docs.collect()}
        if name == "toxicity":
            assert set(own) == before - toxic
        elif name == "line_dedup":
            key = lambda line: line.strip(" \t\n\x0b\f\r")
            low = lambda line: "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in key(line))
            df = Counter(k for t in kept.values() for k in {low(x) for x in t.split("\n")} if k)
            want = {d: "\n".join(x for x in t.split("\n") if df[low(x)] < 10) for d, t in kept.items()}
            assert all(own[d] == want[d] for d in own)
            assert all(not want[d].strip(" ") and want[d] != kept[d] for d in set(kept) - set(own))
        elif name == "near_dedup":
            sets = {d: shingles(t) for d, t in kept.items()}
            alike = lambda x, y: len(x & y) >= 0.8 * len(x | y)
            left = [d for d in own if sets[d]]
            assert not [(a, b) for a in left for b in left if a < b and alike(sets[a], sets[b])]
            # What went has a near copy that was there.
            assert all(any(alike(sets[d], sets[e]) for e in kept if e != d) for d in before - set(own))
        elif name == "decontamination":
            joined = {d: " " + " ".join(plain(t)) + " " for d, t in own.items()}
            assert not [d for d, j in joined.items() if any(" " + " ".join(plain(t)) + " " in j for t in items.values())]
            for d in before - set(own):
                assert max(lcs(plain(t), plain(kept[d])) / max(1, len(plain(t))) for t in items.values()) >= 0.6
        assert set(own) <= before
        kept, before = own, set(own)


def test_registry():
    assert len([q for q in queries.QUERIES if q.startswith("op")]) == 10 and "pipeline" in queries.QUERIES
    assert json.dumps(sorted(queries.ORACLES)) == json.dumps(["op3_line_dedup", "op6_chat_format"])
