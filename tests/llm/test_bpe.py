import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rillflow.llm.bpe import Vocabulary, encode_decode
from rillflow.llm.queries import op8_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return Vocabulary(open(PATH, encoding="utf-8").read())


def ids(own, text):
    packed = own.encode(text)
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def test_every_character(own, library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(characters), 4096):
        for form in ("a{}b ", " {0}{0}1"):
            text = "".join(form.format(c) for c in characters[start : start + 4096])
            assert ids(own, text) == library.encode(text, add_special_tokens=False).ids, (hex(ord(characters[start])), form)


def test_random_texts(own, library):
    pick = random.Random(1)
    alphabet = ["a", "th", "e", " ", "  ", "\n", "\r\n", "\t", "1", "23", "'s", "'ll", "'", "é", "ß", "字", "😀", "!", "!!", "<|endoftext|>", "<|", " ", "\x1c", "²", "_", "́"]
    for _ in range(3000):
        text = "".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40)))
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids, text
        assert own.decode(own.encode(text)) == library.decode(ids(own, text), skip_special_tokens=False)


def test_decode_of_broken_bytes(own, library):
    pick = random.Random(2)
    for _ in range(500):
        some = [pick.randrange(50_257) for _ in range(pick.randint(1, 6))]
        packed = b"".join(i.to_bytes(4, "little") for i in some)
        assert own.decode(packed) == library.decode(some, skip_special_tokens=False)


def test_edge_rows(docs, small_docs, library):
    done = encode_decode(docs, PATH).collect()
    want = Counter((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in small_docs)
    got = Counter((r.doc_id, tuple(int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)), r.decoded) for r in done)
    assert got == want


def test_no_rows(no_docs):
    assert encode_decode(no_docs, PATH).collect() == []


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
