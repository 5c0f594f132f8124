import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import empty, odd_documents

from nearkin.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(encoding.encode_ordinary(text), "<u4").tobytes()


def test_same_ids_as_the_library(ranks, library):
    rng = random.Random(1)
    letters = "aab  \n\t'sé½²Ⅷ文字\x1c12_³-!’́"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    texts += ["a" * 5000, "ab" * 9000, " " * 999, "=-" * 300, "", "日本" * 2000, "".join(rng.choice("abcdefgh") for _ in range(100_000))]
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    ids = codec.encode(texts)
    assert ids == [library(t) for t in texts]
    assert [codec.decode(i).decode() for i in ids] == texts


def test_full_memory_changes_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 500)
    monkeypatch.setattr(bpe, "MERGED_BYTES", 9)
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    texts = ["one two three four five", "six seven eight nine ten eleven", "one two"]
    for text in texts * 2:
        assert codec.encode([text]) == [library(text)]


def test_rank_queue_finds_the_least():
    rng = random.Random(2)
    queue, held = bpe.RankQueue(50_000), set()
    for _ in range(3000):
        rank = rng.randrange(50_000)
        if rank not in held:
            queue.open(rank, [0])
            held.add(rank)
        assert queue.least() == min(held)
        if rng.random() < 0.5:
            queue.drop(min(held))
            held.discard(min(held))
            assert queue.least() == min(held, default=-1)


def test_tables(spark, library):
    rows = odd_documents(spark)
    got = bpe.digests(rows, PATH, public_tokenizers.PATTERN).collect()
    want = []
    for r in rows.collect():
        ids = library(r.text or "")
        want.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    both = bpe.decode(bpe.encode(rows, PATH, public_tokenizers.PATTERN), PATH, ids="ids_")
    assert both.columns == [*rows.columns, "ids_", "decoded"]
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in both.collect())
    assert bpe.digests(empty(spark, "doc_id long, text string"), PATH, public_tokenizers.PATTERN).count() == 0
