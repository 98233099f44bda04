import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyarrow import fs
from tokenizers import Tokenizer, models

from quillmill.llm import packing, queries, token_files, tokens

from .conftest import SF, odd_rows

KINDS = {"word_bpe_49k.json": True, "byte_bpe_50k.json": False}
PIECES = ["the", "Thé", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "　", "'s", "don't", "<|endoftext|>", "<|startoftext|>", "\x01", "é", "ſ", "123", "!?", "日本", "🙂"]


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", KINDS)
@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_ids_equal_the_library_on_whole_texts(name, texts):
    path = public_tokenizers.path(name)
    tokenizer = LIBRARY.setdefault(name, Tokenizer.from_file(path))
    got = [np.frombuffer(b, "<u4").tolist() for b in tokens.encode_texts(path, KINDS[name], texts)]
    assert got == [plain(tokenizer, t) for t in texts]


LIBRARY: dict = {}


def test_a_full_store_changes_nothing():
    for name, drops in KINDS.items():
        encoder = tokens.WordEncoder(public_tokenizers.path(name), drops)
        for _, text, *_ in odd_rows()[:20]:
            assert np.frombuffer(encoder.encode([text or ""], 5)[0], "<u4").tolist() == plain(encoder.tokenizer, text)


def check_packed(rows, texts, capacity=4096):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for key, text in texts:
        ids = plain(tokenizer, text) + [1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4")
            want[key, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(r.length for r in rows)


def test_packing_query(spark, documents):
    used, total = check_packed(queries.QUERIES["op2_packing"](spark, SF).collect(), [(r.doc_id, r.text) for r in documents.collect()])
    assert used <= -(-total // 4096) + 2


def test_packing_odd_rows(odd, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(odd, path).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    assert packing.pack_documents(empty, path).count() == 0


def test_rule_against_its_definition():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 21, 300))[::-1]
    sequence, offset = packing.sum_of_squares(lengths, 20)
    level, counts = {}, Counter()
    for i, s in enumerate(lengths.tolist()):
        change = {}
        for gap in [g for g in counts if counts[g] and s <= g < 20]:
            after = counts.copy()
            after[gap] -= 1
            if gap > s:
                after[gap - s] += 1
            change[gap] = sum(v * v for v in after.values())
        chosen = sequence[i]
        if chosen in level:
            gap = 20 - level[chosen]
            assert change[gap] == min(change.values()) and offset[i] == level[chosen]
            counts[gap] -= 1
        else:
            assert not change and offset[i] == 0
        level[chosen] = offset[i] + s
        if level[chosen] < 20:
            counts[20 - level[chosen]] += 1


def check_files(spark, docs, path, sequence=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    manifest = token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), sequence=sequence)
    got = token_files.read_documents(manifest, path).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    ids = [plain(tokenizer, r.text) + [0] for r in rows]
    want, spans, at = Counter(), Counter(), 0
    for r, x in zip(rows, ids):
        want[r.doc_id, len(x), zlib.crc32(np.array(x, "<u4").tobytes())] += 1
        spans[at, len(x)] += 1
        at += len(x)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    if len({r.doc_id for r in rows}) == len(rows):
        assert Counter((r.start, r.n_tokens) for r in got) == spans
    return manifest


def test_token_files(spark, documents, odd, empty, tmp_path):
    check_files(spark, documents, (tmp_path / "a").as_uri())
    check_files(spark, odd, (tmp_path / "b").as_uri(), sequence=16)
    assert check_files(spark, empty, (tmp_path / "c").as_uri()).count() == 0


def test_ids_beyond_two_bytes_take_four(spark, tmp_path):
    wide = Tokenizer(models.WordLevel({"a": 0, "b": 70_000}, unk_token="a"))
    wide.save(str(tmp_path / "wide.json"))
    byte_bpe = public_tokenizers.path("byte_bpe_50k.json")
    assert token_files.id_type(str(tmp_path / "wide.json")) == pa.uint32() and token_files.id_type(byte_bpe) == pa.uint16()
    docs, path = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id bigint, text string"), (tmp_path / "f").as_uri()
    got = {r.doc_id: r for r in token_files.read_documents(token_files.write_token_files(docs, path, byte_bpe, end_id=70_000), path).collect()}
    assert got[2].ids_crc32 == zlib.crc32(np.array([70_000], "<u4").tobytes())


def test_random_access_is_a_view(spark, documents, tmp_path):
    path = (tmp_path / "files").as_uri()
    row = token_files.write_token_files(documents, path, public_tokenizers.path("byte_bpe_50k.json"), sequence=128).first()
    files, _ = fs.FileSystem.from_uri(path)
    reader = token_files.open_mapped(files, row.path)
    first = token_files.sequences(reader, 70, 3)
    assert first.shape == (3, 128) and not first.flags.owndata and not first.flags.writeable
    masks = sum(reader.get_batch(i).column("mask").flatten().to_numpy(zero_copy_only=False).sum() for i in range(reader.num_record_batches))
    assert masks == row.tokens


def test_token_query(spark, documents):
    rows = queries.QUERIES["op7_token_files"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.collect())


def test_a_small_store_of_words_takes_few_texts_together(monkeypatch):
    from quillmill.llm import tokens

    taken = []
    monkeypatch.setattr(tokens.WordEncoder, "__init__", lambda self, *a: None)
    monkeypatch.setattr(tokens.WordEncoder, "encode", lambda self, texts, stored: taken.append(sum(map(len, texts))) or [t.encode() for t in texts])
    monkeypatch.setattr(tokens, "_ENCODERS", {})
    texts = ["x" * 1_000] * 500
    assert list(tokens.encode_texts("p", True, texts, 2_000)) == [t.encode() for t in texts]
    assert max(taken) <= 2_000 * tokens.CHARACTERS_PER_WORD + 1_000 and sum(taken) == 500_000
