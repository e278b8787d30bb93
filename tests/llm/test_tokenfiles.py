import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer

from biomeframe.llm import tokenfiles
from biomeframe.session import scratch_path
from tests.llm.helpers import AWKWARD, docs_frame, prose

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
BY_WORD, WHOLE = tokenfiles._Encoder(WORD, True), tokenfiles._Encoder(WORD, False)


def joined(encoder, texts):
    out = [(n, flat.tolist(), sizes.tolist()) for n, flat, sizes in encoder.encode(texts)]
    return sum(n for n, _, _ in out), [i for _, f, _ in out for i in f], [i for _, _, s in out for i in s]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text(alphabet="abÉ.,!?' \ndon't", max_size=40)), max_size=5))
def test_word_by_word_equals_whole(texts):
    texts = pa.array([t.encode("utf-8", "ignore").decode() for t in texts], pa.string())
    assert joined(BY_WORD, texts) == joined(WHOLE, texts)


def test_lines_and_slices(monkeypatch):
    texts = pa.array([prose(k, 50) + " plain words. Here, é!" * k for k in range(9)] + ["", None, " "]).fill_null("")
    want = joined(WHOLE, texts)
    monkeypatch.setattr(tokenfiles, "_LINE_WORDS", 7)
    monkeypatch.setattr(tokenfiles, "_DOCS", 2)
    monkeypatch.setattr(tokenfiles, "_WORD_DOCS", 5)
    assert joined(BY_WORD, texts) == want


@pytest.mark.parametrize("path, by_word", [(WORD, True), (WORD, False), (BYTES, False)])
def test_documents(spark, path, by_word):
    docs = AWKWARD + [(90, "don't <|endoftext|> stop, Σας"), (91, prose(2, 60_000))]
    found = tokenfiles.tokenised(docs_frame(spark, docs), path, end_id=1, by_word=by_word).collect()
    whole = Tokenizer.from_file(path)
    ids = lambda t: whole.encode(t or "", add_special_tokens=False).ids + [1]
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    want = sorted((d is not None, d or 0, len(ids(t)), crc(ids(t))) for d, t in docs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == want
    rows = sorted(found, key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id or -1 for r in rows] == sorted(r.doc_id or -1 for r in rows)


def test_format(spark, tmp_path):
    """Frames are plain Zstandard; a damaged one is found; only needed frames are read."""
    path = scratch_path(spark, "tokens")
    index = tokenfiles.write_token_files(docs_frame(spark, [(1, prose(4, 120_000))]), path, WORD, end_id=1)
    row = index.first()
    data = fs.FileSystem.from_uri(f"{path}/{row.file}")
    raw = data[0].open_input_file(data[1]).read()
    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(raw)
    assert len(plain) == row.n_tokens * row.width
    copy = tmp_path / "x.bin"
    copy.write_bytes(raw[:40] + bytes([raw[40] ^ 1]) + raw[41:])
    broken = tokenfiles.TokenFile(fs.LocalFileSystem().open_input_file(str(copy)), row.width)
    assert len(broken.ids(tokenfiles.FRAME_IDS, 10)) == 10
    with pytest.raises(Exception):
        broken.ids(0, 1)


def test_empty(spark):
    assert tokenfiles.tokenised(docs_frame(spark, []), WORD, end_id=1).count() == 0


def test_known_words_do_not_matter(monkeypatch):
    """The same ids with a full, a small and no table of words, batch after batch."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [prose(k, 60) + " straße Ümlaut! 3.14 <|x|> " + "naïve " * (k % 3) for k in range(40)]
    whole = [tokenfiles.Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    for limit in (0, 2000, 48 << 20):
        monkeypatch.setattr(tokenfiles, "KNOWN_BYTES", limit)
        encoder = tokenfiles._Encoder(path, True)
        for at in range(0, len(texts), 7):
            got = []
            for _, flat, sizes in encoder.encode(pa.array(texts[at : at + 7])):
                got += [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
            assert got == whole[at : at + 7]


def test_paths_of_other_stores(tmp_path):
    assert tokenfiles._uri("s3a://bucket/a/b") == tokenfiles._uri("s3n://bucket/a/b") == "s3://bucket/a/b"
    assert tokenfiles._uri("dbfs:/a/b") == "file:///dbfs/a/b"
    assert tokenfiles._files(f"file://{tmp_path}/x")[1] == f"{tmp_path}/x"
