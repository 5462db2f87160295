import os
import random

import numpy as np
import pyarrow as pa
import pytest

from litholake.llm import bpe, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.DEFAULT_DIR), reason="no vocabulary files here")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks())


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{bpe.DEFAULT_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def encode(enc, texts):
    buf, offsets = tokens.text_buffer(pa.array(texts, pa.string()))
    ids, ends = enc.encode(buf, offsets)
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_fuzz_equals_public_tokenizer(encoder, reference):
    r = random.Random(1)
    pool = ["'s", "'t", "'re", "'ll", "'", " ", "  ", "\n", "\t", " ", "　", "a", "Zz", "1", "23", "é", "漢", "🙂", "''", "<|endoftext|>", "!", "‍", "\x1c", "\x85", "²", "ⅷ", "́", "r", "v"]
    texts = ["".join(r.choices(pool, k=r.randint(0, 14))) for _ in range(5000)] + [None, "", " ", "\n\n", "x" * 3000, "ab " * 2000, " " * 500, "'" * 50]
    assert encode(encoder, texts) == reference(texts)


def test_every_entry_is_reached_by_merging(encoder):
    assert [k for k in encoder.ranks if bpe.merge_bytes(k, encoder.ranks) != [encoder.ranks[k]]] == []


def test_hash_is_minimal_and_perfect(encoder):
    assert len(np.unique(encoder.id)) == len(encoder.ranks) == encoder.mph.n


def test_small_hashes():
    for n in (1, 2, 3, 10, 257):
        h = np.random.default_rng(n).integers(0, 2**63, n, dtype=np.uint64)
        assert sorted(bpe.PerfectHash.build(h).slot(h).tolist()) == list(range(n))


def test_column(spark, encoder, reference):
    texts = ["It's a 3×3 kernel", None, "", "deux mots", "deux mots"]
    df = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    b = spark.sparkContext.broadcast(encoder)
    got = [r.ids for r in tokens.encode_column(df.drop("ids"), "text", ["doc_id"], b).orderBy("doc_id").collect()]
    assert got == reference(texts) and got[1] == got[2] == []
    counts = tokens.encode_column(df, "text", ["doc_id"], b, "n", counts_only=True).orderBy("doc_id").collect()
    assert [r.n for r in counts] == [len(x) for x in got]
    assert tokens.encode_column(df.limit(0), "text", ["doc_id"], b).count() == 0


def test_chunks_cover_all_rows():
    offsets = np.cumsum([0, 5, 0, 100, 3, 3, 0])
    parts = list(tokens.chunks(offsets, 8))
    assert parts[0][0] == 0 and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
