import itertools
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm.packing import ChunkEncoder, Packer, closest_fill, pack_documents
from tidemark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_chunks_give_the_ids_of_whole_texts(tokenizer, texts):
    encode, rng = ChunkEncoder(tokenizer_path()), random.Random(3)
    cases = list(texts.values())[:60] + ["x²5 y½ aαb Ⅷ9 ªº", "it's we've he'll,I'd a'sb 'tis", "a<|endoftext|> b <|endoftext|>c", " \n\n x\t\ty  "]
    for alphabet in ("aZ é́ß²½5 \n\t'sdtm.,!<|>αЖ漢 \x1c_-", "aZ éß5 \n\t'sdtmrevl.,!_-\x1c"):
        cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    for text in cases:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def check(df, tokenizer):
    rows = pack_documents(df, tokenizer_path()).collect()
    wanted = {}
    for r in df.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        wanted.setdefault((r.doc_id, len(ids)), []).append(ids)
    windows, covered = {}, {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        covered.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
        assert any(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for ids in wanted[r.doc_id, r.doc_tokens])
    for pieces in windows.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at == 1024 or at & (at - 1) == 0  # no padding
    for key, texts in wanted.items():
        count = np.zeros(key[1], int)
        for start, n in covered[key]:
            count[start:start + n] += 1
        assert (count == len(texts)).all()
    assert set(covered) == set(wanted)


def test_documents_and_edge_cases(docs, edge, empty, tokenizer):
    check(docs, tokenizer)
    check(edge, tokenizer)
    assert pack_documents(empty, tokenizer_path()).collect() == []


def test_closest_fill():
    rng = random.Random(0)
    for _ in range(300):
        capacity, counts = rng.randint(1, 14), [0] + [rng.randint(0, 3) for _ in range(8)]
        total, picks = closest_fill(counts, capacity)
        sums = {sum(n * c for n, c in enumerate(use)) for use in itertools.product(*(range(c + 1) for c in counts))}
        assert total == max(s for s in sums if s <= capacity)
        assert sum(n * c for n, c in picks) == total and all(0 < c <= counts[n] for n, c in picks)


def test_windows_are_filled_before_the_end():
    packer, rng = Packer(64, 0), random.Random(2)
    for doc in range(500):
        packer.hold(doc, 0, b"abcd" * rng.randint(1, 63))
        if doc % 100 == 99:
            packer.pack(False)
    packer.pack(True)
    sums = {}
    for _, _, ids, seq, _ in packer.out:
        sums[seq] = sums.get(seq, 0) + len(ids) // 4
    assert all(n == 64 or n & (n - 1) == 0 for n in sums.values()) and sum(n != 64 for n in sums.values()) <= 6
