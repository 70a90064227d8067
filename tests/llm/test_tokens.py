import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from brute import rows, sha

from ledgerloom.llm import packing, sentencepiece_spans
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = [" ", "  ", "\n", "a", "b", "the", "'s", "'", "é", "▁", "\t", "　", "x.", "a.", '"', "日本", "\0", "😀", "1", "12 ", "\x1c", "\x85",
       "​", "<s>", "<unk>", "<0x41>", "<|endoftext|>", ",", "é."]


TABLE = pq.read_table(f"{SF}/documents.parquet").to_pylist()


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(13))) for _ in range(n)] + ["", " ", "x" * 30_000, "word " * 5_000]


def test_op10_is_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for r in rows(spark, SF, "documents"):
        ids = model.encode(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids)), len((r["text"] or "").encode())))
    assert sorted(map(tuple, QUERIES["op10_sentencepiece"](spark, SF).collect())) == sorted(want)


def test_pieces_and_spans_of_odd_texts():
    encode = sentencepiece_spans.Encoder(MODEL)
    for text in odd_texts(4000, 1):
        ids, begins, ends = encode(text)
        data = text.encode()
        assert ids.tolist() == encode.whole.encode(text)
        assert b"".join(data[b:e] for b, e in zip(begins, ends)) == data
        assert encode.decoded(text, ids) == encode.whole.decode(ids.tolist())


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc"])
def test_compiled_maps_are_followed(rule):
    from sentencepiece import sentencepiece_model_pb2 as pb

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    raw = library.serialized_normalizer_spec
    spec = pb.NormalizerSpec()
    spec.ParseFromString(raw() if callable(raw) else raw)
    chars = sentencepiece_spans.CharMap(spec.precompiled_charsmap)
    for text in ["ＡＢＣ ﬁ  x½", " a  b ", "カ゛ガ Å", "éx", "", "x​ y\0z", "①Ⅷ", "ﷺ ®™"]:
        data, begins, ends = sentencepiece_spans.normalize(text, chars, spec.add_dummy_prefix, spec.remove_extra_whitespaces)
        assert data.decode().replace(" ", "▁") == library.Normalize(text)
        source = text.encode()
        assert all(0 <= b <= e <= len(source) for b, e in zip(begins, ends)) and (np.diff(begins) >= 0).all()


def test_tables_with_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, "x", 5), (None, "a b", None, 6), (1, "a b", "y", 7)], "doc_id long, text string, ids string, ends int")
    out = sentencepiece_spans.decode(sentencepiece_spans.encode(df, MODEL), MODEL).collect()
    assert sorted((r["decoded"], len(r["ids"])) for r in out) == [("", 0), ("a b", 2), ("a b", 2)]
    assert sentencepiece_spans.encode(df.limit(0), MODEL).count() == 0


def test_words_are_the_vocabulary():
    encode = packing.Words(VOCABULARY)
    for text in odd_texts(4000, 2) + [r["text"] or "" for r in TABLE]:
        assert encode(text) == encode.direct(text), repr(text[:50])
    words = sorted({w for r in TABLE for w in (r["text"] or "").split()})
    assert all(encode.word(" " + w) == encode.direct(" " + w) for w in words)


def test_special_strings_have_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(VOCABULARY)  # as it comes
    texts = ["end <|endoftext|> start", "<|endoftext|>", "a<|endoftext|>b c", "no <|endoftext| here", "x  <|endoftext|>\n"] + odd_texts(300, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.tokenize(df, VOCABULARY, capacity=1 << 20).collect()}
    assert got[0] == [437, 220, 50256, 923, 1]
    for i, t in enumerate(texts):
        assert got[i] == [*model.encode(t, add_special_tokens=False).ids, 1], t


def test_op5_holds_every_id_once(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(VOCABULARY)
    model.encode_special_tokens = True
    pieces = [r.asDict() for r in QUERIES["op5_packing"](spark, SF).collect()]
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for r in rows(spark, SF, "documents"):
        ids = np.array([*model.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(by_doc.pop(r["doc_id"]), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    assert not by_doc
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
    total = sum(p["length"] for p in pieces)
    assert len(by_sequence) * 2048 <= total * 1.01 + 2048


def test_first_fit_takes_the_leftmost_bin():
    rng = random.Random(4)
    for _ in range(30):
        lengths = [rng.randrange(1, 101) for _ in range(rng.randrange(1, 120))]
        room, want = [], [0] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            room += [100] * (at == len(room))
            room[at] -= lengths[i]
            want[i] = at
        assert packing.first_fit(lengths, 100) == want
    with pytest.raises(ValueError):
        packing.first_fit([101], 100)


def test_sequences_and_odd_tables(spark):
    df = spark.createDataFrame([(1, "a b c", 3), (1, "a b c", 4), (None, None, 5), (2, "word " * 3000, 6)], "doc_id long, text string, start int")
    packed = packing.pack(packing.tokenize(df, VOCABULARY))
    held = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] and r["length"] <= 2048 for r in held)
    assert packed.filter("doc_id IS NULL").first()["doc_tokens"] == 1
    assert packing.pack(packing.tokenize(df.limit(0), VOCABULARY)).count() == 0
