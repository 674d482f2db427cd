"""Line dedup against brute force; packing against the tokenizer, piece by piece."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfsense.llm import line_dedup, packing

JSON, RANKS = public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS)


def brute_lines(rows, min_chars=40, min_docs=5):
    holders = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    number = lambda i: -(2**63) if i is None else i
    for n, (i, t) in enumerate(rows):
        for line in set(map(key, (t or "").split("\n"))):
            if len(line) >= min_chars:
                holders.setdefault(line, []).append(number(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders.get(key(x), [])) < min_docs or number(i) == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay) if len(stay) < len(lines) else t))
    return sorted(out, key=str)


def test_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 4)  # several shards
    rng = random.Random(5)
    pool = [f"line number {k} with É and enough letters to be long" for k in range(30)] + ["short"] * 3
    dress = [str, str.upper, lambda s: f"  {s}\t", lambda s: s.replace("É", "é")]
    rows = [(i, "\n".join(rng.choice(dress)(rng.choice(pool)) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (3, rows[3][1]), (None, pool[0]), (None, None), (203, "y" * 50_000), (204, pool[1] + "\r\n" + pool[1])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, keeper string, n_lines int")
    got = line_dedup.without_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "keeper", "n_lines", "n_dropped"]
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=str) == brute_lines(rows)
    assert line_dedup.without_repeated_lines(docs.limit(0)).collect() == []


def test_minimal_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, (5000, 2)).astype(np.uint64)
    levels = line_dedup.build(keys)
    assert sorted(line_dedup.index(levels, keys).tolist()) == list(range(5000))
    assert line_dedup.build(keys[:0]) == [] and line_dedup.index([], keys[:3]).tolist() == [-1, -1, -1]


def full_ids(text):
    return Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "", " ", "a", "It's  two  spaces", "three   spaces and\n\n lines \t tabs ", "don't 'll we're", "ende. Él niño, straße!", "数字 and 日本語 text",
    "<|endoftext|> inside <|endoftext|>", "nb sp   em", "é combining", "\u0085next", " lead", "trail ", "a\nb\r\nc", "🙂 smile 🙂", "１２ ２", "x" * 3000,
    "퟿", "1,234.50 $5 100%", "--- *** ===", "\x1c\x1d sep \x7f", "İstanbul ǅ",
])
def test_ids_are_those_of_the_tokenizer(text):
    assert np.frombuffer(packing.encode(text, JSON, RANKS), "<u2").tolist() == full_ids(text)


def test_pieces(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta,", "γ", "delta's", "\n", "99"]) for _ in range(rng.choice([0, 1, 40, 900])))) for i in range(60)]
    rows += [(70, None), (71, ""), (None, "no id"), (5, "same id again"), (72, "word " * 9000)]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, start int").repartition(3)
    pieces = packing.pack(docs, JSON, RANKS).collect()
    expected = {}
    for i, t in rows:
        ids = np.array(full_ids(t or "") + [1], "<u4")
        expected.setdefault((i, len(ids)), []).append(ids)
    at = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * 2048 + p["offset"] == at and p["offset"] + p["length"] <= 2048
        at += p["length"]
        assert any(zlib.crc32(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"] for ids in expected[p["doc_id"], p["doc_tokens"]])
    assert at == sum(len(ids) for group in expected.values() for ids in group)
    report = packing.padding(packing.pack(docs, JSON, RANKS)).first()
    assert report["tokens"] == at and report["padding"] < 2048
    assert packing.pack(docs.limit(0), JSON, RANKS).collect() == []
