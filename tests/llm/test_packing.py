from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm.packing import pack, piece_lengths, write_buckets

TEXTS = [
    None, "", "Hello world", "<|endoftext|> x<|endoftext|>", " " * 9000, "漢字 мир १२ ½", "é" * 3000,
    "one two three " * 1500, "\x00\x1c\x85   x", "I'll 'S he's", "a" * 5000,
]


def test_pieces_hold_every_id_once(docs, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [*enumerate(TEXTS), (2, TEXTS[2]), (None, "null id")]
    got = pack(docs(rows)).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    seen: dict = {}
    for r in got:
        assert r.length == len(r.ids) and r.length & (r.length - 1) == 0 and r.length <= 2048
        assert r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        seen.setdefault(r.doc_id, []).append(r)
    for key, text in rows[: len(TEXTS)] + rows[-1:]:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(seen[key], key=lambda r: r.start)
        if key == 2:
            pieces = pieces[::2]
        assert [x for p in pieces for x in p.ids] == ids, key
        assert {p.doc_tokens for p in pieces} == {len(ids)}
    write_buckets(pack(docs(rows)), str(tmp_path / "out"))
    assert pack(docs([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 2047, 2048, 2049, 5000])
def test_lengths(n):
    found = piece_lengths(n)
    assert sum(found) == n and found == sorted(found, reverse=True)
    assert len(set(found[n // 2048 :])) == len(found[n // 2048 :])


def test_bad_length(docs):
    with pytest.raises(ValueError):
        pack(docs([]), longest=1000)
