"""Packing and token files, against the tokenizer library and exact round trips."""

import collections
import zlib

import numpy as np
import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

from llm_fixtures import ODD, SMALL, frame, none, odd, small  # noqa: F401
from sparkplate.llm import binary, packing
from sparkplate.llm.tokens import WordEncoder, vocabulary

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text, end: np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_word_encoder_equals_library(library):
    encoder = WordEncoder(vocabulary(PATH), cache=20)
    texts = [r[1] for r in ODD] + ["İstanbul Σας ΟΔΟΣ", "H̱ello é café", "don't I'll, x., 3.14 µ ß ÀÉ", "日本 語。", "a\x85b c\x1cd", "ª º ²½", "Word, word. WORD., ,,, .",
             "hello <|endoftext|> world", "a<|endoftext|>b, c", "<|STARTOFTEXT|>x <|EndOfText|>", "<|startoftext|><|endoftext|>", "<| endoftext |> <|"]
    for text in texts * 2:
        assert encoder.ids(text) == library(text, 2)[:-1].tobytes(), text


def check_packing(rows, got, library):
    ids = [library(t, 2) for _, t in rows]
    left = collections.Counter((d, x.tobytes()) for (d, _), x in zip(rows, ids))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for (doc, raw), times in left.items():  # every piece of every copy is there, once
        x = np.frombuffer(raw, "<u4")
        starts = packing.cut_points(len(x), packing.CAPACITY, packing.MAX_PIECE)
        for a, b in zip(starts, [*starts[1:], len(x)]):
            same = [r for r in by_doc[doc] if (r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) == (a, b - a, len(x), zlib.crc32(x[a:b].tobytes()))]
            assert len(same) >= times
    assert sum(r["length"] for r in got) == sum(map(len, ids))
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.CAPACITY


def test_packing_odd_rows(spark, odd, library):
    check_packing([r[:2] for r in ODD], packing.pack_documents(odd, PATH).collect(), library)


def test_added_tokens_in_texts(spark, library, tmp_path):
    rows = [(1, "hello <|endoftext|> world", "en", "a"), (2, "a<|endoftext|>b", "en", "a"), (3, "plain words", "en", "a")]
    docs = frame(spark, rows)
    check_packing([r[:2] for r in rows], packing.pack_documents(docs, PATH).collect(), library)
    binary.write_tokens(docs, str(tmp_path / "added"), vocabulary(PATH))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in binary.read_tokens(spark, str(tmp_path / "added")).collect()}
    assert got == {d: (len(x), zlib.crc32(x.tobytes())) for d, t, *_ in rows for x in [library(t, 1)]}
    assert got[1][0] == 4


def test_packing_real_rows(spark, small, library):
    got = packing.pack_documents(small[0], PATH).collect()
    check_packing([r[:2] for r in small[1]], got, library)
    used = len({r["sequence_id"] for r in got}) * packing.CAPACITY
    assert sum(r["length"] for r in got) > 0.95 * used


def test_packing_empty_table(none):
    assert packing.pack_documents(none, PATH).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_differencing_balances_and_keeps_all(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 1025, int(rng.integers(1, 400))).tolist()
    for k in (1, 2, 7, len(sizes)):
        sums, members = packing.difference(sizes, k)
        assert sorted(i for m in members for i in m) == list(range(len(sizes)))
        assert [sum(sizes[i] for i in m) for m in members] == sums.tolist() and len(members) <= k
    windows = packing.fill(sizes, 4096)
    assert sorted(i for m in windows for i in m) == list(range(len(sizes)))
    assert max(sum(sizes[i] for i in m) for m in windows) <= 4096
    assert len(windows) <= -(-sum(sizes) // 4096) * 1.1 + 1


@pytest.mark.parametrize("seed", range(8))
def test_blocks_round_trip(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.choice([0, 1, 511, 512, 513, 5000]))
    ids = rng.integers(0, int(rng.choice([1, 2, 300, 49408, 1 << 32])), n).astype("<u4")
    ids[rng.random(n) < 0.05] = (1 << 32) - 1
    payload, starts = binary.encode(ids)
    assert (binary.decode(payload, starts, n) == ids).all()
    for _ in range(5):
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (binary.decode(payload, starts, n, a, b) == ids[a:b]).all()


def test_token_files_odd_rows(spark, odd, none, library, tmp_path, monkeypatch):
    for name, chunk in (("wide", 1 << 18), ("narrow", 100)):
        path = str(tmp_path / name)
        binary.write_tokens(odd, path, vocabulary(PATH), chunk=chunk)
        got = sorted(binary.read_tokens(spark, path).collect(), key=lambda r: r["start"])
        assert [r["doc_id"] for r in got] == sorted((r[0] for r in ODD), key=lambda d: -1 if d is None else d)
        at = 0
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
        ids = [library(r[1], 1) for r in ODD]
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted(
            (str(r[0]), len(x), zlib.crc32(x.tobytes())) for r, x in zip(ODD, ids))
    binary.write_tokens(none, str(tmp_path / "none"), vocabulary(PATH))
    assert binary.read_tokens(spark, str(tmp_path / "none")).count() == 0
