import os
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from ledgermill.llm import token_files as tf
from ledgermill.llm.common import documents
from tests.conftest import SMALL
from tests.llm.conftest import odd, with_clashes

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def brute(rows, plain):
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*plain(text), 1]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(spark, df, **options):
    folder = tf.token_folder(spark)
    manifest = tf.write_token_files(df, folder, PATH, end_id=1, **options)
    return folder, manifest, tf.document_digests(spark, folder)


def by_start(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_documents_read_back_as_encoded(spark, plain):
    df = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    _, manifest, got = written(spark, df, by_word=True)
    assert by_start(got) == brute(rows, plain)
    assert manifest.agg({"tokens": "sum", "documents": "sum"}).first()[0] == len(rows)


@pytest.mark.parametrize("by_word", [True, False])
def test_odd_rows(spark, docs, plain, by_word):
    df = with_clashes(odd(docs))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    _, _, got = written(spark, df, by_word=by_word, length=16, rows=4)
    assert by_start(got) == brute(rows, plain)


def test_empty_table(spark, docs):
    _, manifest, got = written(spark, docs((1, "a")).limit(0))
    assert manifest.count() == 0 and got.count() == 0


def test_sequences_are_views_with_masks(spark, docs, plain):
    folder, manifest, _ = written(spark, docs(*[(i, f"word {i} of many here") for i in range(100)], parts=1), length=8, rows=5)
    total = 0
    stream = []
    for part in manifest.orderBy("part").collect():
        path = f"{folder}/{part.file}.arrow"
        sequences = tf.SequenceFile(path)
        for i in range(len(sequences)):
            ids, mask = sequences.sequence(i)
            assert len(ids) == len(mask) == 8 and ids.dtype == np.uint16 and not ids.flags.owndata
            stream += ids[: mask.true_count].tolist()
            assert mask.true_count == 8 or i == len(sequences) - 1
        total += part.tokens
    assert len(stream) == total
    assert stream == [x for i in range(100) for x in [*plain(f"word {i} of many here"), 1]]


def test_words_alone_encode_as_in_their_text(plain):
    random.seed(4)
    pieces = ["The", "it's", "don't!!", "naïve", "éa", "́x", "日本語", "a\x01b", "\x01", "x|y", "1234", "ΣΑΣ", "\x1c\x1d", " ", "<|endoftext|>", "<|ENDOFTEXT|>", ".", ",", ".,", "...", "word,", "word.", "é.", "…,", "7,", "İ", "ŉ", "ª", "ĸß", "ñandú", "ǅ", "😀", "�", "<|x"]
    texts = ["".join(random.choice([*pieces, " ", "\n", "\t ", "\r\n"]) for _ in range(random.randrange(30))) for _ in range(400)]
    encoder = tf.WordEncoder(PATH)
    assert encoder.folds and encoder.mark is not None and encoder.closes.any()
    ids, sizes = encoder.encode([t.encode() for t in texts], 1)
    want = [[*plain(t), 1] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and sizes.tolist() == [len(w) for w in want]


def test_a_full_memory_starts_over(plain, monkeypatch):
    monkeypatch.setattr(tf, "MEMORY", 20)
    encoder = tf.WordEncoder(PATH)
    for k in range(30):
        text = " ".join(f"w{k}x{i}" for i in range(15)) + " the end"
        assert encoder.encode([text.encode()], None)[0].tolist() == plain(text)
    assert len(encoder.table) <= 40


def test_files_of_failed_attempts_are_not_listed(spark, docs):
    folder, manifest, got = written(spark, docs((1, "a b"), (2, "c")), by_word=True)
    with open(os.path.join(folder, "part-00000-0.arrow"), "w") as f:
        f.write("left by a lost task")
    assert tf.document_digests(spark, folder).count() == 2 == got.count()


def test_stores_are_named_as_the_file_library_knows_them():
    names = {"s3a://b/x": "s3://b/x", "S3N://b/x": "s3://b/x", "hdfs://h/x": "hdfs://h/x", "/a/b:c": "/a/b:c", "file:///a": "file:///a", "wasbs://c@a/x": "abfss://c@a/x"}
    assert {n: tf.store_uri(n) for n in names} == names


def test_long_texts_without_a_break(spark, docs, plain):
    rows = [(1, "ab1" * 30_000), (2, "x\n" * 100_000), (3, None)]
    _, _, found = written(spark, docs(*rows), by_word=True)
    assert by_start(found) == brute(rows, plain)
