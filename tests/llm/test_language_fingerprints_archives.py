import gzip
import hashlib
import io
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmill.llm import imatch, language_id, queries, warc

from .conftest import SF


def held_out(id):
    return zlib.crc32(str(id).encode()) % 5 == 0


def test_language_query_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op1_language_id"](spark, sf).collect()
    assert len(got) == len(docs) and all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in unseen) >= 0.98 * len(unseen)


def test_a_fit_never_sees_held_out_rows(spark, documents):
    spoilt = documents.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert "xx" not in language_id.fit(spoilt).languages
    shuffled = documents.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, None).otherwise(F.col("lang")))
    rows = language_id.training_sample(shuffled, "doc_id", "text", "lang", 10, 2, 50, 0)
    assert rows and all(r["id"] % 2 == 1 and not held_out(r["id"]) and len(r["text"]) <= 50 for r in rows)
    assert max(Counter(r["lang"] for r in rows).values()) <= 10 and len({r["lang"] for r in rows}) <= 2


def test_sample_keeps_its_bound_when_an_id_repeats(spark):
    key = next(i for i in range(100) if not held_out(i))
    rows = [(key, f"text {i % 150} of one id", ("aa", "bb")[i % 2]) for i in range(600)] + [(key, "same", "cc")] * 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = Counter(r["lang"] for r in language_id.training_sample(docs, "doc_id", "text", "lang", 10, 3, 50, 0))
    assert max(got.values()) <= 10 and got.get("cc", 0) <= 1


def kernel(a, b):
    grams = lambda t: {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    x, y = grams(f" {a} "), grams(f" {b} ")
    return len(x & y) / (len(x) * len(y)) ** 0.5


def test_kernel_against_its_definition():
    """Landmark rows as fitted are the presence kernel over the landmarks' n-grams."""
    import numpy as np

    texts = ["abc abd", "abd bcd dd", "dcba", "cab"]
    presence = language_id.Presence("abcd")
    vectors = []
    grams = [np.unique(np.concatenate([g for c in presence.codes(t) for g in presence.grams(c)])) for t in texts]
    every = np.unique(np.concatenate(grams))
    for g in grams:
        v = np.isin(every, g).astype(float)
        vectors.append(v / np.sqrt(v.sum()))
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert abs(vectors[i] @ vectors[j] - kernel(a, b)) < 1e-9


def test_rare_scripts_have_letters_of_their_own():
    """More letters than a small alphabet holds; the two rarest scripts differ only by theirs."""
    import random

    rng = random.Random(4)
    starts = {"latin": 0x61, "cyrillic": 0x430, "georgian": 0x10D0, "han": 0x4E00, "hangul": 0xAC00, "yi": 0xA000}
    sizes = {"latin": 26, "cyrillic": 32, "georgian": 33, "han": 200, "hangul": 60, "yi": 60}
    line = lambda k, n: " ".join("".join(chr(starts[k] + rng.randrange(sizes[k])) for _ in range(4)) for _ in range(n))
    rows = [(k, line(k, 5 if k in ("hangul", "yi") else 60)) for k in starts for _ in range(20)]
    model = language_id.fit_sample(rows)
    unseen = [(k, line(k, 30)) for k in starts for _ in range(10)]
    assert [k for k, _ in language_id.score_texts(model, [t for _, t in unseen])] == [k for k, _ in unseen]


def test_long_texts_are_read_to_their_end(monkeypatch):
    model = language_id.fit_sample([("a", "aba abab bab"), ("b", "xyx yxy xyxy")] * 4, landmarks=2)
    whole = language_id.score_texts(model, ["ab " * 50 + "xyx yxyx " * 400])
    monkeypatch.setattr(language_id, "CHARS", 7)
    assert language_id.score_texts(model, ["ab " * 50 + "xyx yxyx " * 400]) == whole


def test_languages_of_odd_rows(odd, empty):
    rows = language_id.predict(odd, language_id.fit(odd)).collect()
    assert len(rows) == odd.count() and set(rows[0].asDict()) == {"row", "lang_pred", "score"}
    lettered = lambda t: any(c.isalpha() for c in t or "")
    assert all((r.lang_pred == "und") == (not lettered(r.row.text)) for r in rows)
    nobody = language_id.fit(odd.where("lang = 'none'"))
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, nobody).collect()} == {("und", 0.0)}
    assert language_id.predict(empty, language_id.fit(empty)).count() == 0


def edited_by_hand(texts):
    """Texts in descending id order; the next of the last is the first."""
    for i, text in enumerate(texts):
        half, after = len(text) // 2, texts[(i + 1) % len(texts)]
        yield text[: len(text) - half] + after[:half], after


def test_fingerprint_query(spark, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op4_imatch"](spark, SF).collect()}
    rows = sorted(documents.collect(), key=lambda r: -r.doc_id)
    texts = [r.text or "" for r in rows]
    for i, (r, (edited, _)) in enumerate(zip(rows, edited_by_hand(texts))):
        one, after = got[r.doc_id], got[rows[(i + 1) % len(rows)].doc_id]
        assert one.n_chars == len(texts[i]) and one.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert one.near_next == pytest.approx(likeness(one.fingerprint, after.fingerprint))
        assert one.near_edited == pytest.approx(likeness(one.fingerprint, one.edited_fingerprint))
    by_text = Counter((t, got[r.doc_id].fingerprint) for r, t in zip(rows, texts))
    assert len(by_text) == len(set(texts))
    mean = lambda v: sum(v) / len(v)
    assert mean([r.near_edited for r in got.values()]) > 0.1 > 10 * mean([r.near_next for r in got.values()])


def likeness(a, b):
    slots = [(a[i : i + 8], b[i : i + 8]) for i in range(0, len(a), 8)]
    known = [x == y for x, y in slots if (x, y) != (imatch.EMPTY, imatch.EMPTY)]
    return sum(known) / max(len(known), 1)


def test_fingerprints_of_odd_rows(odd, empty):
    rows = imatch.fingerprints(odd.select("text")).collect()
    prints = {}
    for r in rows:
        assert len(r.fingerprint) == 24 and prints.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert imatch.fingerprints(empty).count() == 0


def test_next_texts_of_odd_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    distinct = {(r.doc_id, r.text or "") for r in rows}
    got = imatch.with_next_text(odd, carried=lambda t: F.length(t)).collect()
    assert Counter((r.id, r.text) for r in got) == Counter((r.doc_id, r.text or "") for r in rows)
    order = sorted({i for i, _ in distinct if i is not None}, reverse=True)
    texts = dict((i, t) for i, t in distinct if i is not None)
    for a, b in zip(order, order[1:]):
        if a != order[-1] and sum(i == b for i, _ in distinct) == 1:
            one = next(r for r in got if r.id == a)
            half = len(texts[a]) // 2
            assert one.edited == texts[a][: len(texts[a]) - half] + texts[b][:half] and one.next == len(texts[b])
    assert imatch.with_next_text(empty).count() == 0


def test_lexicon_is_the_band(spark, monkeypatch):
    rows = [(" ".join(["common", f"only{i}", f"pair{i // 2}"]),) for i in range(40)]
    monkeypatch.setattr(imatch, "THIN", 1)
    words = imatch.lexicon(spark.createDataFrame(rows, "text string")).first()["words"]
    set_bits = sum(bin(w & (2**64 - 1)).count("1") for w in words)
    assert len(words) == imatch.LEXICON_BITS // 64 and 18 <= set_bits <= 20


def test_all_terms_of_the_band_enter_the_lexicon(spark):
    rows = [(f"both{i // 2} twin{i // 2} only{i}",) for i in range(400)]
    docs = spark.createDataFrame(rows, "text string")
    words = imatch.lexicon(docs).first()["words"]
    assert 395 <= sum(bin(w & (2**64 - 1)).count("1") for w in words) <= 400
    texts = spark.createDataFrame([(f"both{i}",) for i in range(200)], "text string")
    kept = texts.select(F.size(imatch.thin_terms(F.col("text"))).alias("n")).collect()
    assert all(r.n == 1 for r in kept)


def types_by_hand(pages):
    first = {}
    for r in pages:
        data = (r.html or "").encode()
        if len(data) >= 100 and r.page_id is not None:
            first[data] = min(first.get(data, r.page_id), r.page_id)
    for r in pages:
        data = (r.html or "").encode()
        repeats = data in first and first[data] != r.page_id
        yield r.page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if repeats else "response", first[data] if repeats else None


def archived(pages, path):
    written = warc.write_archives(pages, f"{path}/whole")
    return warc.normalise_archives(written, f"{path}/members")


def test_archives(spark, tmp_path):
    page = "<p>é</p>" * 20
    rows = [(5, "http://a/ü b\r\nX: y", page), (3, "http://b", page), (3, "http://b", page), (9, None, page), (1, "u", None), (2, "u", ""), (4, "u", "x" * 99), (6, "u", "x" * 99), (None, "u", page), (None, None, None), (7, "u", "WARC/1.1\r\n\r\n" * 30), (8, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).withColumn("id", F.lit(2)).repartition(3)
    members = archived(pages, tmp_path.as_uri())
    got = warc.read_archives(members, tmp_path.as_uri()).collect()
    assert Counter(map(tuple, got)) == Counter(types_by_hand(pages.collect()))
    nothing = archived(pages.limit(0), (tmp_path / "none").as_uri())
    assert nothing.count() == 0 and warc.read_archives(nothing, tmp_path.as_uri()).count() == 0


def test_archive_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert Counter(map(tuple, queries.QUERIES["op9_warc"](spark, SF).collect())) == Counter(types_by_hand(pages))


def records(n=5):
    return [warc.page_record(i, f"http://x/{i}", f"page {i} ".encode() * 50 * i, 0, revisit=i == 3) for i in range(n)]


def test_normaliser_keeps_every_record_and_finds_it_by_offset():
    plain = b"".join(records())
    for source in (gzip.compress(plain), gzip.compress(plain[:700]) + gzip.compress(plain[700:])):
        target = io.BytesIO()
        entries = list(warc.normalise_stream(io.BytesIO(source), target))
        assert gzip.decompress(target.getvalue()) == plain and len(entries) == 5
        for record, e in zip(records(), entries):
            assert zlib.decompress(target.getvalue()[e["offset"] : e["offset"] + e["length"]], wbits=31) == record
        fields, http, payload = warc.read_record(target, entries[2]["offset"], entries[2]["length"])
        assert payload == b"page 2 " * 100 and fields["warc-target-uri"] == "http://x/2" and http["content-length"] == str(len(payload))


def test_cut_archives_are_errors():
    plain = b"".join(records())
    with pytest.raises(EOFError):
        list(warc.normalise_stream(io.BytesIO(gzip.compress(plain)[:-400]), io.BytesIO()))
    with pytest.raises(EOFError):
        list(warc.normalise_stream(io.BytesIO(gzip.compress(plain[:-600])), io.BytesIO()))
    with pytest.raises(ValueError):
        list(warc.normalise_stream(io.BytesIO(gzip.compress(b"no archive\r\n\r\n")), io.BytesIO()))
