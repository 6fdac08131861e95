import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quotemill.llm import token_files
from quotemill.llm.sentencepiece_codec import PieceCodec, decode_documents, encode_documents, round_trip_digest
from quotemill.llm.tables import map_arrow
from tests.llm.tables import awkward, empty, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(5)
    out = ["", " ", "  a  b ", "\n\n x\t", "▁a ▁▁ b", "日本語 🙂", "a" * 3000, "<s> </s> <0x41>", "a　b\x85c", "x <|endoftext|> y", "'s it's  'll"]
    for _ in range(400):
        out.append("".join(rng.choice("ab  \n.,é日▁🙂'\"0<>xT\t\x1c") for _ in range(rng.randint(0, 40))))
    return out


def test_pieces_equal_the_library():
    own, library = PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in odd_texts() + [prose(200)]:
        ids = library.encode(text)
        assert own.encode(text) == ids, text
        assert not ids or own.decode(ids) == library.decode(ids)


def test_decoding_arbitrary_ids_equals_the_library():
    own, library = PieceCodec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(2)
    for _ in range(400):
        ids = [rng.choice([rng.randint(0, 258), rng.randint(0, 31999)]) for _ in range(rng.randint(1, 9))]
        assert own.decode(ids) == library.decode(ids), ids


def test_full_tables_do_not_change_ids(monkeypatch):
    monkeypatch.setattr("quotemill.llm.sentencepiece_codec.KEPT_WORDS", 3)
    monkeypatch.setattr("quotemill.llm.sentencepiece_codec.KEPT_PAIRS", 3)
    assert PieceCodec(PIECES).encode(prose(50)) == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(prose(50))


def test_a_worker_drops_the_codec_for_other_work(spark):
    def left(batches):
        import gc

        from quotemill.llm.sentencepiece_codec import PieceCodec

        for batch in batches:
            gc.collect()
            yield [[sum(isinstance(x, PieceCodec) for x in gc.get_objects())] * batch.num_rows]

    docs = spark.createDataFrame([(i, prose(20, i)) for i in range(16)], "doc_id long, text string").repartition(8)
    for _ in range(2):
        assert round_trip_digest(docs, PIECES).count() == 16
        round_trip_digest(docs, PIECES).write.format("noop").mode("overwrite").save()
        assert {r.n for r in map_arrow(docs, left, "n int").collect()} == {0}


def test_round_trip_of_awkward_rows(spark):
    docs = awkward(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sorted(map(tuple, round_trip_digest(docs, PIECES).collect()), key=str)
    wanted = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids) if ids else "")))
    assert got == sorted(wanted, key=str)
    assert round_trip_digest(empty(spark), PIECES).collect() == []
    back = decode_documents(encode_documents(docs, PIECES), PIECES)
    assert sorted(back.select("text").collect()) == sorted((t or "",) for (t,) in docs.select("text").collect())


def test_byte_ids_equal_the_library():
    own, library = token_files.ByteEncoder(BYTES), Tokenizer.from_file(BYTES)
    listed = odd_texts()
    for text, ids in zip(listed, own.encode(listed)):
        assert np.frombuffer(ids, own.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("shards", [1, 5])
def test_token_files(spark, tmp_path, shards):
    docs, library, folder = awkward(spark), Tokenizer.from_file(BYTES), f"file://{tmp_path}/tokens"
    written = token_files.write_tokens(docs, BYTES, folder, shards=shards)
    got = token_files.read_digests(spark, folder).orderBy("start").collect()
    rows = docs.select("doc_id", "text").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, wanted = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == wanted
    assert sum(s.n_tokens for s in written) == start


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_tokens(empty(spark), BYTES, str(tmp_path / "none"), shards=2)
    assert token_files.read_digests(spark, str(tmp_path / "none")).collect() == []
