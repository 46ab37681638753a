from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from tallywatch.llm import subwords as s
from tallywatch.llm.common import ready
from tests.llm.helpers import collected, empty_docs, odd_docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rnd = random.Random(3)
    return ["", " ", "  a  b\nc\t　d ﬁ", " lead", "trail  ", "日本語 テスト😀 x", "<0x0A> <unk> </s>", "The quick brown fox, thinking.",
            *("".join(rnd.choices("ab éß日😀\n\t .", k=rnd.randint(0, 30))) for _ in range(300))]


def test_equals_the_library_as_a_unigram_model():
    mine = s.Unigram.load(PATH)
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece, score in zip(proto.pieces, mine.scores):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    for text in texts():
        ids, theirs = mine.encode(text).tolist(), library.encode(text)
        # The library adds in single precision: where it differs, the sums are equal up to that.
        assert ids == theirs or abs(sum(mine.scores[i] for i in ids) - sum(mine.scores[i] for i in theirs)) < 1e-3
        assert mine.decode(ids) == text == library.decode(ids)


def brute(model, marked):
    """Best score over all segmentations, characters falling back alone."""
    best = {0: 0}
    for end in range(1, len(marked) + 1):
        options = []
        for start in range(end):
            piece = marked[start:end]
            number = model.plain.get(piece)
            if number is not None:
                options.append(best[start] + model.steps[number])
            elif end - start == 1:
                options.append(best[start] + model.lowest)
        best[end] = max(options)
    return best[len(marked)]


def test_viterbi_equals_brute_force():
    rnd = random.Random(8)
    for _ in range(30):
        pieces = sorted({"".join(rnd.choices("ab▁", k=rnd.randint(1, 4))) for _ in range(rnd.randint(1, 12))})
        byte = list(range(256))
        names = [f"<0x{b:02X}>" for b in byte] + pieces
        model = s.Unigram(names, [0.0] * 256 + [-rnd.random() * 5 for _ in pieces], list(range(256, len(names))), byte)
        model.plain = {p: 256 + i for i, p in enumerate(pieces)}
        for _ in range(20):
            text = "".join(rnd.choices("abc ", k=rnd.randint(1, 9)))
            ids = model.encode(text).tolist()
            assert model.decode(ids) == text
            marked = s.MARK + text.replace(" ", s.MARK)
            covered = sum(model.steps[i] for i in ids if i >= 256)
            bytes_ = sum(len(c.encode()) for c in marked) - sum(len(names[i].encode()) for i in ids if i >= 256)
            assert bytes_ == sum(i < 256 for i in ids)
            alone = sum(1 for c in bytes(i for i in ids if i < 256).decode())
            assert covered + alone * model.lowest == brute(model, marked)


def test_trie_holds_its_keys():
    rnd = random.Random(1)
    keys = {bytes(rnd.choices(range(256), k=rnd.randint(1, 5))): i for i in range(2000)}
    trie = s.DoubleArray.build(keys)
    for key in list(keys)[:300]:
        whole = key + b"zz"
        assert list(trie.prefixes(whole, 0)) == [(n, keys[whole[:n]]) for n in range(1, len(whole) + 1) if whole[:n] in keys]


def test_query_and_round_trip(spark):
    docs = odd_docs(ready(spark), [(100 + i, t) for i, t in enumerate(texts())])
    model = s.Unigram.load(PATH)
    wanted = []
    for r in docs.collect():
        ids = model.encode(r.text or "")
        wanted.append((r.doc_id, len(ids), sum(int(i) in set(model.byte) for i in ids), zlib.crc32(ids.tobytes()), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(collected(s.digests(docs)), key=repr) == sorted(wanted, key=repr)
    back = s.decoded(s.encoded(docs))
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((r.doc_id or 0, r.text or "") for r in docs.collect())
    assert collected(s.digests(empty_docs(spark))) == [] and math.isfinite(model.scores[500]) and isinstance(ids, np.ndarray)
