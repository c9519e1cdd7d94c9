import random
import zlib

import helpers
import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import orc_tokens, plans
from textloom.llm.common import pieces, utf8

PATH = plans.tokenizer_path()
PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "1", "23", "!", "--", "’", "中", "\x1c", "×", ".", "ñ", "\xa0", "😀", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def encode(texts, most):
    encoder = orc_tokens.Encoder(PATH)
    body, offsets = utf8(pa.array(texts, pa.string()))
    out = []
    for a, b in pieces(offsets, most):
        at = offsets[a : b + 1]
        ids, counts = encoder(body[at[0] : at[-1]], at - at[0])
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


def test_words_give_the_ids_of_the_whole_text(library):
    r = random.Random(1)
    texts = ["".join(r.choice(PARTS[: 18 + i % 7]) for _ in range(r.randint(0, 14))) for i in range(4_000)]
    texts += helpers.ODD_TEXTS + ["'", "'s", " 's", "a's", "a'sb", "''s", "x'll 'llx", helpers.prose(3, 5_000)]
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for most in (50, 1 << 20):
        assert encode(texts, most) == want


def test_words_are_forgotten_when_the_table_is_full(library, monkeypatch):
    monkeypatch.setattr(orc_tokens, "KNOWN_WORDS", 10)
    texts = [helpers.prose(s, 200) for s in range(5)]
    assert encode(texts, 100) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def expected(rows, library):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("table", ["odd", "sf"])
def test_files_hold_the_ids_in_order(spark, library, table):
    docs = helpers.odd_docs(spark) if table == "odd" else plans.table(spark, "/root/testdata/sf0.001", "documents")
    got = orc_tokens.tokenized(docs, PATH)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert helpers.rows_of(got, "doc_id", "start", "n_tokens", "ids_crc32") == expected(rows, library)


def test_ids_come_back_and_lookups_are_pushed_down(spark, library, folder):
    docs = plans.table(spark, "/root/testdata/sf0.001", "documents")
    orc_tokens.write_tokens(docs, f"{folder}/ids", PATH)
    one = orc_tokens.read_tokens(spark, f"{folder}/ids").filter("doc_id = 7")
    assert "EqualTo(doc_id,7)" in one._jdf.queryExecution().toString()
    text = docs.filter("doc_id = 7").first().text
    assert one.first().ids == [*library.encode(text, add_special_tokens=False).ids, 0]


def test_empty_table(spark):
    assert orc_tokens.tokenized(helpers.no_docs(spark), PATH).collect() == []
