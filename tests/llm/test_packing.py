"""Packing: every id once, gapless sequences, ids of the tokenizer itself, least cost by brute force."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streambed.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return lambda text: model.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_those_of_the_tokenizers_library(spark, plain):
    rng = random.Random(3)
    bits = ["the", " ", "  ", "\n", " \n", "don't", "42", "é", "\t", " ", "　", "x" * 60, "!?", "<|endoftext|>", "\x1c", "👍🏽", "."]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(1, 300)])) for _ in range(30)) for _ in range(3000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    model, _ = packing.load_tokenizer(PATH)
    assert [np.frombuffer(packing.encode(model, t), "<u4").tolist() for t in texts] == [plain(t) for t in texts]


def test_pieces_cover_every_id_once(spark, plain, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 3000)
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["one", "two.", "three\n", "Zürich"]) for _ in range(rng.choice([0, 1, 40, 900])))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "y" * 9000), (103, "same."), (104, "same.")]
    rows = packing.packing_digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), PATH).collect()
    ids = {d: [*plain(t), 0] for d, t in docs}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for held, total in [(by_doc[d], len(x)) for d, x in ids.items()] + [(x, None) for x in by_sequence.values()]:
        at = 0
        for begin, n in sorted(held):
            assert begin == at
            at += n
        assert at == total if total is not None else at <= 1024


def test_dynamic_program_is_least():
    rng = random.Random(7)
    for _ in range(30):
        gaps = [rng.randint(1, 9) for _ in range(40)]
        at = np.concatenate([[0], np.cumsum(gaps)])
        price = np.array([0] + [rng.choice([0, 2, 5]) for _ in gaps])
        best = [0] + [10 ** 9] * len(gaps)
        for i in range(1, len(at)):
            best[i] = min(best[j] + 20 - (at[i] - at[j]) + price[i] for j in range(i) if at[i] - at[j] <= 20)
        ends = packing.best_cuts(at, price, 20)
        where = {int(c): p for c, p in zip(at, price, strict=True)}
        cost = sum(20 - (e - b) + where[e] for b, e in zip([0, *ends[:-1]], ends, strict=True))
        assert cost == best[-1] and ends[-1] == at[-1]


def test_empty_table(spark):
    assert packing.packing_digest(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_special_strings_are_their_token_as_by_default(spark):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = ["a <|endoftext|> b", end, f"{end}{end}", f"x{end}y", f"  {end}  z", f"one.  {end}\n\n{end}", "<|endoftext|", "<|ENDOFTEXT|>", "don't 42 é 👍🏽", "", f"{end} " * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = defaultdict(list)
    for r in sorted(packing.pack(docs, PATH).collect(), key=lambda r: r.start):
        got[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
        assert r.doc_tokens == len(model.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1
    assert dict(got) == {k: [*model.encode(t, add_special_tokens=False).ids, 0] for k, t in enumerate(texts)}
    assert got[0] == [64, 220, 50256, 275, 0]
