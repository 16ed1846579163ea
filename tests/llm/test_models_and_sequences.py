"""Language, toxicity, quality, fingerprints, pieces and WARC on small tables."""

import datetime as dt
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import fingerprints, langid, pieces, resample, toxicity, warc
from tidemart.llm.rows import held_out, packed, unpacked
from tidemart.session import work_dir

DOCS = "doc_id bigint, text string, lang string, score string"
WORDS = {"en": "the of and that with", "fr": "les des été où voilà", "de": "über und nicht schön der"}


def prose(r, lang, n):
    return " ".join(r.choice(WORDS[lang].split()) + r.choice(["", ".", "!"]) for _ in range(n))


def test_held_out_follows_crc32(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(x["h"] == (zlib.crc32(str(x["id"]).encode()) % 5 == 0) for x in rows)


# Language ------------------------------------------------------------------------------------


def test_language_of_held_out_texts_and_odd_rows(spark):
    r = random.Random(1)
    rows = [(i, prose(r, lang, r.randint(4, 60)), lang, "x") for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(1000, None, "en", "x"), (1001, "", "fr", "x"), (1002, "123 !?", "de", "x"), (None, prose(r, "fr", 9), "fr", "x")]
    rows += [(1003, prose(r, "de", 30), None, "x"), rows[0], (1004, prose(r, "en", 200_000), None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs, sample=90)
    plain = docs.select("doc_id", "text", "lang")
    found = langid.predict(plain, model).collect()
    assert len(found) == len(rows) and all(0 <= x["score"] <= 1 for x in found)
    by_id = {x["doc_id"]: x["lang_pred"] for x in found}
    assert [by_id[i] for i in (1000, 1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "de", "en", "fr"]
    truth = [(x["lang"], x["lang_pred"]) for x in found if x["doc_id"] and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0]
    assert np.mean([a == b for a, b in truth if a]) > 0.95


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None, "x")], DOCS)
    assert [x["lang_pred"] for x in langid.predict(docs.select("text"), langid.train(docs)).collect()] == ["und"]
    assert langid.predict(docs.limit(0).select("text"), langid.train(docs.limit(0))).count() == 0


def test_counts_do_not_depend_on_pieces(monkeypatch):
    text = prose(random.Random(2), "fr", 300) + "🦀日本"
    whole = langid.counts(text)[0]
    monkeypatch.setattr(langid, "PIECE_CHARS", 50)
    assert (langid.counts(text)[0] == whole).all()


def test_packed_rows_keep_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], "row int, text string, `odd name.x` string, score string")
    assert unpacked(packed(df), df.columns).collect() == df.collect()


# Toxicity ---------------------------------------------------------------------------------------


def test_toxicity_separates_held_out_texts(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        text = prose(r, r.choice(list(WORDS)), r.randint(20, 60)) + (" such a vermin " + prose(r, "en", 5) if toxic else "")
        rows.append((i, text, "en", "x"))
        if i % 5 < 3:  # a sample that is alike, as the class prior supposes
            labels.append((i, 1, int(toxic)))
    rows += [(2000, None, "en", "x"), (2001, "", "en", "x"), rows[0]]
    labels += [labels[0], (None, 1, 1), (5000, 1, 1), (3, 1, None)]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    scores = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert len(scores) == len(rows) and all(0 <= x["score"] <= 1 for x in scores)
    right = [(x["score"] >= 0.5) == (x["doc_id"] < 900 and x["doc_id"] % 6 == 0) for x in scores]
    assert np.mean(right) > 0.97
    none = toxicity.train(docs, marks.limit(0))
    assert {x["score"] for x in toxicity.score(docs, none).collect()} == {none.score(np.zeros(0, int))}
    assert toxicity.score(docs.limit(0), none).count() == 0


# Importance resampling ----------------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 7, 250, 600, 601])
def test_kth_largest(spark, monkeypatch, k):
    monkeypatch.setattr(resample, "SORTED_ROWS", 20)
    monkeypatch.setattr(resample, "BINS", 8)
    r = random.Random(k)
    values = [float(r.choice([r.randint(-5, 5), r.random() * 1e6])) for _ in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = sorted(values, reverse=True)[k - 1] if k <= 600 else None
    assert resample.kth_largest(df, "v", k) == expected


def test_resampling_prefers_the_target(spark):
    r = random.Random(6)
    rows = [(i, prose(r, "en" if i % 4 else "de", 40), "en", "x") for i in range(200)] + [(300, None, "en", "x"), (301, "a", "en", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    target = docs.where("doc_id % 4 <> 0 and doc_id < 200")
    found = resample.resample(docs, resample.train(docs, target), 0.75).collect()
    kept = [x["doc_id"] for x in found if x["kept"]]
    assert len(found) == len(rows) and len(kept) == round(0.75 * len(rows))
    assert np.mean([i % 4 != 0 for i in kept if i < 200]) > 0.95
    ratios = resample.train(docs, target.limit(0))
    assert not ratios.any() and resample.resample(docs.limit(0), ratios, 0.5).count() == 0


# Fingerprints -------------------------------------------------------------------------------------


def test_fingerprints_of_edits(spark):
    r = random.Random(8)
    texts = [prose(r, r.choice(list(WORDS)), r.randint(0, 80)) for _ in range(40)] + ["", None, "é👍\nab", "x", "same text", "same text", "y\n" * 3000]
    ids = r.sample(range(-50, 1000), len(texts))
    docs = spark.createDataFrame([(i, t, "en", "x") for i, t in zip(ids, texts)], DOCS)
    found = {x["doc_id"]: x for x in fingerprints.fingerprint_edits(docs).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    assert len(found) == len(order)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        change = text[: len(text) - half] + after[:half]
        x = found[i]
        assert x["n_chars"] == len(text) and x["edited_sha256"] == hashlib.sha256(change.encode()).hexdigest()
        a, b, c = (set(fingerprints.paragraphs(t.encode()).tolist()) for t in (text, change, after))
        share = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert x["near_edited"] == pytest.approx(share(a, b)) and x["near_next"] == pytest.approx(share(a, c))
    same = [found[i]["fingerprint"] for i, t in zip(ids, texts) if t == "same text"]
    assert len(set(same)) == 1
    one = fingerprints.fingerprint_edits(docs.limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert fingerprints.fingerprint_edits(docs.limit(0)).count() == 0


def test_repeated_and_missing_ids_follow_each_other(spark):
    docs = spark.createDataFrame([(5, "a b", "", ""), (5, "a b", "", ""), (None, "c d e", "", ""), (7, "f", "", "")], DOCS)
    found = fingerprints.fingerprint_edits(docs).collect()
    assert sorted((x["doc_id"] or -1, x["n_chars"]) for x in found) == [(-1, 5), (5, 3), (5, 3), (7, 1)]


def test_sketches_give_the_difference(spark):
    r = np.random.default_rng(1)
    sets = lambda: [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 1, 5, 40, 900)]
    a, b = sets(), sets()
    b[3] = np.unique(np.concatenate([a[3][:30], b[3][:2]]))
    for x, y, (left, right) in zip(a, b, fingerprints.differences(a, b, 12)):
        assert sorted(left.tolist()) == sorted(set(x.tolist()) - set(y.tolist()))
        assert sorted(right.tolist()) == sorted(set(y.tolist()) - set(x.tolist()))


# Pieces ----------------------------------------------------------------------------------------------


def test_pieces_equal_the_library_and_decode(spark):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=pieces.MODEL)
    r = random.Random(9)
    texts = ["", " ", "a", "a  b", "\n", " \n x", "日本語👍🏽", "▁x", "a" * 300, "    " * 9, "\x00\t é", "int main() { return 0; }"]
    texts += ["".join(r.choice(" \nabcdeéthionÉß.-=▁x\t012日👍") for _ in range(r.randint(0, 40))) for _ in range(300)]
    rows = [(i, t, "en", "x") for i, t in enumerate([*texts, None, texts[5]])]
    vocabulary = pieces.load()
    encoded = pieces.encode(spark.createDataFrame(rows, DOCS).select("doc_id", "text", "score"), vocabulary)
    back = pieces.decode(encoded.withColumnRenamed("text", "asked"), vocabulary).collect()
    assert len(back) == len(rows)
    for x in back:
        asked = x["asked"] or ""
        assert x["pieces"] == library.encode(asked) and x["text"] == asked.replace("▁", " ")
    assert pieces.encode(spark.createDataFrame([], DOCS).select("text"), vocabulary).count() == 0


def test_encoder_forgets_without_harm(monkeypatch):
    vocabulary = pieces.load()
    texts = [f"word{i} some other{i % 7} text" for i in range(60)]
    expected = [x.tolist() for x in pieces.Encoder(vocabulary).encode(texts)]
    monkeypatch.setattr(pieces, "KNOWN_CHUNKS", 10)
    monkeypatch.setattr(pieces, "KNOWN_NEIGHBOURS", 5)
    monkeypatch.setattr(pieces, "INDEX_CHARS", 30)
    small = pieces.Encoder(vocabulary)
    assert [small.encode([t])[0].tolist() for t in texts] == expected


# WARC -----------------------------------------------------------------------------------------------

RECORDS = "record_id bigint, kind string, url string, at timestamp, headers map<string,string>, payload string, status string, slice int"


def moment(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=n)


def test_revisits(spark):
    etag = lambda v, **more: {"ETag": v, **more}
    rows = [
        (1, "response", "http://www.A.org/x/", moment(0), etag('"1"', **{"Content-Type": "t", "Date": "d0"}), "one", "s", 1),
        (2, "revisit", "https://a.org/x#top", moment(5), etag('W/"1"', **{"date": "d5", "Content-Length": "0"}), None, "s", 1),
        (3, "response", "http://a.org:80/x", moment(9), etag('"2"'), "two", "s", 1),
        (4, "revisit", "http://a.org/x", moment(9), etag('"1"'), None, "s", 1),  # not earlier: the first answer
        (5, "revisit", "http://a.org/x", moment(10), etag('"1"'), None, "s", 1),
        (6, "revisit", "http://a.org/x", moment(11), {}, None, "s", 1),
        (7, "revisit", "http://b.org/", moment(1), etag('"1"'), None, "s", 1),
        (8, "revisit", None, moment(1), etag('"1"'), None, "s", 1),
        (9, "revisit", "http://a.org/x", None, etag('"1"'), None, "s", 1),
        (10, "revisit", "http://a.org/x", moment(12), None, None, "s", 1),
        (11, "response", "http://c.org?b=2&a=1", moment(1), {"last-modified": "m"}, None, "s", 1),
        (12, "revisit", "http://c.org/?a=1&b=2", moment(2), {"Last-Modified": "m"}, None, "s", 1),
    ]
    rows.append(rows[1])
    found = warc.resolve_revisits(spark.createDataFrame(rows, RECORDS), slices=3).collect()
    assert len(found) == len(rows)
    by_id = {x["record_id"]: x for x in found}
    status = {k: (x["status"], x["response_id"]) for k, x in by_id.items()}
    assert status == {
        1: ("full", None), 2: ("resolved", 1), 3: ("full", None), 4: ("resolved", 1), 5: ("changed", None),
        6: ("no_validator", None), 7: ("no_earlier", None), 8: ("no_earlier", None), 9: ("no_earlier", None),
        10: ("no_validator", None), 11: ("full", None), 12: ("resolved", 11),
    }
    assert by_id[2]["merged"] == {"etag": 'W/"1"', "content-type": "t", "date": "d5"} and by_id[2]["payload"] == "one"
    assert warc.resolve_revisits(spark.createDataFrame([], RECORDS)).count() == 0


def test_warc_files_round_trip(spark):
    rows = [(f"{i}", "revisit" if i % 3 == 2 else "response", f"http://a.org/{i}", moment(i), {"ETag": f'"{i}"', "X": "a: b"},
             "" if i % 3 == 2 else f"<p>é {i}</p>\n\nline\n") for i in range(20)]
    schema = "record_id string, kind string, url string, at timestamp, headers map<string,string>, payload string"
    path = work_dir(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, schema), path)
    back = sorted(map(tuple, warc.read_warc(spark, path).collect()), key=lambda x: int(x[0]))
    assert back == [r for r in rows]


def test_neighbours_hold_together_as_merging_says():
    """Whole and cut pieces against merging the two texts as one, also without end pieces."""
    import random

    from tidemart.llm import pieces

    v = pieces.load()
    known = [p for p, i in v.ids.items() if v.sound[i]]
    rng, broken = random.Random(8), 0
    for k in range(20_000):
        a, b = rng.choice(known), rng.choice(known)
        if k % 2 and len(a) > 1:
            cut = rng.randint(1, len(a) - 1)
            a, b = a[:cut], a[cut:]
            if not all(p in v.ids and v.sound[v.ids[p]] for p in (a, b)):
                continue
        expected = v.merged(a + b) == [a, b]
        broken += not expected
        assert v.together(a, b) == expected
    assert broken > 1000 and v.together("\U0001f9ff", "a")
    # A vocabulary whose pieces are not merged after their halves.
    odd = pieces.Vocabulary(["ab", "abc", "a", "b", "c"], {"ab": -5.0, "abc": -1.0, "a": 0.0, "b": 0.0, "c": 0.0}, list(range(256)))
    assert odd.left_ends is None and not odd.together("ab", "c") and odd.together("c", "ab")


def test_decoding_of_many_rows_equals_one_by_one():
    from tidemart.llm import pieces

    v = pieces.load()
    decoder, encoder = pieces.Decoder(v), pieces.Encoder(v)
    texts = ["", " ", "a", " two  words ", "é𝄞\n\x00", "▁▁x", "word " * 3000]
    rows = [list(map(int, e)) for e in encoder.encode(texts)]
    rows += [[], [v.byte_ids[0xC3]], [v.byte_ids[0xC3], v.byte_ids[0xA9]], [0, 1, 2]]
    values = np.array(sum(rows, []), dtype=np.int32)
    offsets = np.cumsum([0, *map(len, rows)])
    for most in (1, 7, 500_000):
        pieces.RUN_PIECES, before = most, pieces.RUN_PIECES
        assert decoder.decode_all(values, offsets).to_pylist() == [decoder.decode(r) for r in rows]
        pieces.RUN_PIECES = before
    assert decoder.decode_all(values[:0], np.array([0])).to_pylist() == []


def test_revisits_under_repeated_and_missing_ids(spark):
    at = moment
    tag = lambda t: {"ETag": t}
    rows = [
        (1, "response", "http://a.org/", at(0), tag('"a"'), "body a"),
        (1, "response", "http://b.org/", at(0), tag('"b"'), "body b"),
        (None, "response", "http://c.org/", at(0), tag('"c"'), "body c"),
        (5, "revisit", "http://a.org/", at(9), tag('"a"'), None),
        (5, "revisit", "http://b.org/", at(9), tag('"b"'), None),
        (5, "revisit", "http://b.org/", at(9), tag('"b"'), None),
        (None, "revisit", "http://a.org/", at(9), tag('"a"'), None),
        (None, "revisit", "http://c.org/", at(9), tag('"c"'), None),
        (None, "revisit", None, at(9), tag('"c"'), None),
        (None, "revisit", "http://c.org/", None, None, None),
    ]
    shape = "record_id bigint, kind string, url string, at timestamp, headers map<string,string>, payload string, status string, uid int"
    docs = spark.createDataFrame([(*r, "mine", 7) for r in rows], shape)
    told = warc.resolve_revisits(docs, slices=2)
    assert told.columns.count("status") == 1
    found = sorted(
        ((r["record_id"], r["canonical_url"], r["status"], r["response_id"], r["payload"], r["uid"]) for r in told.collect() if r["kind"] == "revisit"),
        key=str,
    )
    expected = [
        (5, "a.org", "resolved", 1, "body a", 7),
        (5, "b.org", "resolved", 1, "body b", 7),
        (5, "b.org", "resolved", 1, "body b", 7),
        (None, "a.org", "resolved", 1, "body a", 7),
        (None, "c.org", "resolved", None, "body c", 7),
        (None, None, "no_earlier", None, None, 7),
        (None, "c.org", "no_earlier", None, None, 7),
    ]
    assert found == sorted(expected, key=str) and told.count() == len(rows)


def test_repeated_and_very_many_headers_are_read(spark):
    folder = work_dir(spark, "warc")
    many = "".join(f"X-{i}: {i}\r\n" for i in range(12_000))
    http = f"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nset-cookie: c\r\nSet-Cookie: b=2\r\n{many}\r\nbody"
    head = f"WARC-Type: response\r\nWARC-Record-ID: <urn:record:1>\r\nWARC-Target-URI: http://a/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {len(http)}"
    spark.createDataFrame([(f"{warc.VERSION}\r\n{head}\r\n\r\n{http}\r\n\r\n",)], "value string").write.text(folder)
    row = warc.read_warc(spark, folder).first()
    assert row["headers"]["Set-Cookie"] == "a=1, b=2" and row["headers"]["set-cookie"] == "c"
    assert len(row["headers"]) == 12_002 and row["headers"]["X-11999"] == "11999" and row["payload"] == "body"


def test_pieces_pass_between_spark_and_python_a_few_mb_at_a_time(spark):
    import pyarrow as pa

    from tidemart.llm import pieces
    from tidemart.session import BATCH_BYTES

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    vocabulary = pieces.load()
    texts = spark.range(4000, numPartitions=1).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ab ")), 600).alias("text"))
    encoded = pieces.encode(texts, vocabulary)
    found = encoded.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 4000
    assert max(r["size"] for r in found) < 2 * BATCH_BYTES
    back = pieces.decode(encoded.withColumnRenamed("text", "asked"), vocabulary)
    assert back.where("rtrim(text) = rtrim(asked)").count() == 4000


def test_chunks_that_are_needed_again_stay_known(monkeypatch):
    from tidemart.llm import pieces

    learned = []
    monkeypatch.setattr(pieces, "KNOWN_CHUNKS", 10)
    monkeypatch.setattr(pieces.Encoder, "_learn", lambda self, keys, learn=pieces.Encoder._learn: (learned.extend(keys), learn(self, keys)))
    encoder = pieces.Encoder(pieces.load())
    encoder.encode(["the cat and the dog sat on a mat"])
    encoder.encode(["the dog " + " ".join(f"word{i}" for i in range(9))])
    assert learned.count("the") == learned.count("dog") == 1
    assert len(encoder.chunks) <= 11
