import json
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
LETTERS = ["a", "B", "the", "é", "ß", "語", "́", "'s", "'", "n't", " ", " ", "  ", "   ", "\n", "\n", "\t",
           "\r\n", "\x0b", " ", " ", "　", "\x1c", "\x01", "\x85", "1", "234", ".", ",", "!?", "-",
           "<|endoftext|>", "😀", "​", "²", "Σ", "ʰ", "٣", "क्"]


def hostile(rng, n):
    words = ["word", "Word,", "don't", "x.", " ", "\n", " ", "Straße", "naïve;", "ab12", "\n"]
    return ["", *("".join(rng.choices(rng.choice([LETTERS, words]), k=rng.randint(0, 14))) for _ in range(n))]


def test_encoder_equals_whole_texts(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 200)  # generations turn over
    encoder = packing.ByteEncoder(PATH)
    assert encoder.chunked
    plain = Tokenizer.from_file(PATH)
    texts = hostile(random.Random(2), 6000)
    for k in range(0, len(texts), 500):
        part = texts[k:k + 500]
        ids, ends = encoder.encode(pa.array([*part, None]))
        assert len(ends) == len(part) + 2 and ends[-1] == ends[-2]
        for text, a, b in zip(part, ends[:-1], ends[1:], strict=False):
            assert ids[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids, text
        assert len(encoder.spaced.young) <= 200 + 2 * 500 * 15


def test_other_tokenizers_encode_whole_texts(tmp_path):
    spec = json.load(open(PATH))
    spec["normalizer"] = {"type": "Lowercase"}
    other = tmp_path / "lower.json"
    other.write_text(json.dumps(spec))
    encoder, plain = packing.ByteEncoder(str(other)), Tokenizer.from_file(str(other))
    assert not encoder.chunked
    texts = ["Some TEXT here", "x  y\n"]
    ids, ends = encoder.encode(pa.array(texts))
    for text, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, size):
    """Best fit, longest first, one piece at a time: room left by sequence."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else size
        rooms.insert(bisect_left(rooms, room - n), room - n)
    return rooms


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_by_piece(seed):
    rng = random.Random(seed)
    size = rng.choice([5, 16, 100, 1024])
    lengths = rng.choices(range(1, size + 1), weights=[rng.random() ** 3 for _ in range(size)], k=rng.randint(0, 3000))
    lengths += [1] * rng.randint(0, 400) + [size] * rng.randint(0, 9)
    counts = Counter(lengths)
    plan = packing.plan(counts, size)
    used = defaultdict(list)
    for n, count in counts.items():
        sequence, offset = plan.slots(np.full(count, n), np.arange(count))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            used[s].append((o, n))
    for pieces in used.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= size
    assert len(used) == plan.sequences == len(plain_best_fit(lengths, size))
    assert sorted(size - sum(n for _, n in p) for p in used.values()) == plain_best_fit(lengths, size)


def plain_pieces(text, size, end=2, tokenizer=Tokenizer.from_file(PATH)):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
    first = len(ids) % size or size
    cuts = [0, *range(min(first, len(ids)), len(ids) + 1, size)]
    return [(k, a, ids[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]


@pytest.mark.parametrize("size", [64, 1024])
def test_pack_equals_plain(spark, docs, rows, empty, size):
    fmt = packing.PackFormat(PATH, length=size)
    got = packing.pack(docs, fmt).collect()
    want = Counter((r[0], k, a, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                   for r in rows for k, a, ids in plain_pieces(r[1], size))
    assert Counter(tuple(r)[:5] for r in got) == want
    seats = defaultdict(list)
    for r in got:
        seats[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in seats.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= size
    assert len(seats) == len(plain_best_fit([r["length"] for r in got], size))
    assert packing.pack(empty, fmt).collect() == []


def test_packed_sequences_hold_the_ids(spark, docs, rows):
    fmt = packing.PackFormat(PATH, length=128)
    found = Counter()
    for r in packing.packed_sequences(docs, fmt).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) <= 128
        ends = [p["offset"] for p in r["pieces"]][1:] + [len(ids)]
        for p, end in zip(r["pieces"], ends, strict=True):
            found[(p["doc_id"], p["piece"], tuple(ids[p["offset"]:end]))] += 1
    assert found == Counter((r[0], k, tuple(ids)) for r in rows for k, _, ids in plain_pieces(r[1], 128))


def test_hot_length(spark):
    """Most pieces share one length; ranks need no common task."""
    df = spark.range(0, 6000, 1, 12).selectExpr("id AS doc_id", "IF(id % 5 = 0, concat('w ', id), '') AS text")
    got = packing.pack(df, packing.PackFormat(PATH)).collect()
    assert len(got) == 6000 and len({(r["sequence_id"], r["offset"]) for r in got}) == 6000
    assert len({r["sequence_id"] for r in got}) == -(-sum(r["length"] for r in got) // 1024)
