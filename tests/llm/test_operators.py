import hashlib
import math
import os
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose, rows
from tonnage.llm import decontamination, fingerprints, language, lines, packing, queries, repeats, scoring, simhash, suffixes, token_files, warc
from tonnage.llm.components import components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_bpe())


def key(doc):
    return (doc is None, doc or 0)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# token files and packing


def test_token_files_round_trip(spark, docs, tokenizer):
    got = collected(token_files.token_file_index(docs, queries.word_bpe()))
    encoded = [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t, *_ in rows()]
    encoded.sort(key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]), crc(x[1])))
    expected, at = [], 0
    for d, ids in encoded:
        expected.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
@settings(max_examples=60, deadline=None)
def test_rank_coding_round_trip(values):
    ranks = np.array(values, np.uint32)
    assert token_files.unpack_ranks(*token_files.pack_ranks(ranks), len(ranks)).tolist() == values


@pytest.fixture(scope="module")
def chunks():
    return token_files.encoder(queries.word_bpe())


@given(st.text(st.sampled_from(list("abXYZ  \n\t'stre0129.,!?-_<|>ÉßİıΣςµªº²\u0301\u0308\u00a0\u200bẞﬁ\u3000中한\U0001f600\x1c\x85\x00ŉǰ")), max_size=30))
@settings(max_examples=400, deadline=None)
def test_chunked_encoding_is_the_library_s(chunks, text):
    raw = text.encode()
    assert chunks.encode([raw])[0] == chunks.whole(raw)


def test_packing_places_every_piece(docs, tokenizer):
    got = packing.pack_documents(docs, queries.word_bpe(), capacity=256).collect()
    expected = []
    for d, t, *_ in rows():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        expected += [(d, k, s, len(ids[s : s + 256]), crc(ids[s : s + 256])) for k, s in enumerate(range(0, len(ids), 256))]
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.05 * sum(r.length for r in got) / 256 + 1


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1, max_size=25))
@settings(max_examples=60, deadline=None)
def test_plan_is_whole_and_gapless(histogram):
    runs, made = packing.best_plan(histogram, 40)
    sequences, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, first, offset in runs:
        ranks[length] += range(rank, rank + n)
        for k in range(n):
            sequences[first + k].append((offset, length))
    assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(n)) for x, n in histogram.items()}
    assert set(sequences) == set(range(made))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40


def test_linear_programme_beats_one_size_at_a_time():
    _, made = packing.best_plan({6: 100, 4: 100, 10: 5}, 10)
    assert made == 105


@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 30)), min_size=1, max_size=20, unique_by=lambda x: x[0]), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_groups_are_of_equal_cardinality_and_round_up(lengths, groups):
    lengths = sorted(lengths, reverse=True)
    found = packing.equal_groups(lengths, groups)
    total = sum(n for _, n in lengths)
    size = -(-total // groups)
    assert sum(n for some in found.values() for _, n in some) == total and len(found) <= groups
    assert all(length <= rounded for rounded, some in found.items() for length, _ in some)
    assert Counter(x for some in found.values() for x, n in some for _ in range(n)) == Counter(x for x, n in lengths for _ in range(n))
    order = [x for x, n in lengths for _ in range(n)]  # a group is rounded up to its own longest
    assert set(found) == {order[k] for k in range(0, total, size)}


def test_configurations_hold_several_large_pieces():
    ((counts, uses),) = [(c, u) for c, u in packing.configurations([2500, 1500], [40, 40], 4096) if u > 0.5]
    assert counts.tolist() == [1, 1] and uses == pytest.approx(40)
    for groups, large in packing.GROUPINGS:  # every grouping has large pieces to plan: none is best fit alone
        runs, made = packing.plan({2500: 40, 1500: 40, 90: 40}, 4096, groups, large)
        assert made == 40 and groups > 1 and large > 2
        assert sum(n for length, _, n, _, _ in runs if length == 2500) == 40


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_packing_reaches_the_bound_on_a_corpus(spark):
    got = queries.QUERIES["op2_best_fit_packing"](spark, "/root/testdata/sf0.01").collect()
    assert len({r.sequence_id for r in got}) <= -(-sum(r.length for r in got) // 4096) + 1


# decontamination


def test_contamination_in_one_block_or_many(spark, docs):
    bench = spark.createDataFrame([(1, rows()[9][1]), (2, "omicron"), (2, rows()[6][1]), (3, None), (4, "..."), (None, "emoji")], "item_id long, text string").selectExpr("*", "1 as hit")
    one, many = (collected(decontamination.contamination(docs, bench, block_words=n).drop("items", "spans")) for n in (400_000, 20))
    assert one == many
    expected = []
    items = [("1", rows()[9][1]), ("2", "omicron"), ("2", rows()[6][1]), ("", "emoji")]
    split = [(i, decontamination.words(t.encode())) for i, t in items]
    wanted = {(i, tuple(w[k : k + 10])) for i, w in split for k in range(max(1, len(w) - 9))}
    for d, t, *_ in rows():
        w = decontamination.words((t or "").encode())
        hit, found = set(), set()
        for i, window in wanted:
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    found.add(i)
        expected.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert one == sorted(expected, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_contamination_spans_are_text_offsets(spark):
    text = "Óne — two, THREE\n" + " ".join(f"w{k}" for k in range(12)) + "!"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(f"W{k}" for k in range(1, 11)))], "item_id long, text string")
    (span,) = decontamination.contamination(docs, bench).first()["spans"]
    assert text[span["start"] : span["end"]] == " ".join(f"w{k}" for k in range(1, 11))


def test_empty_benchmark_hits_nothing(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs, bench).where("contaminated").count() == 0


# language-model scores


@pytest.mark.parametrize(("buckets", "salts"), [(5, 1), (3, 4)])
def test_scores_equal_a_plain_model(docs, buckets, salts):
    words, counts, order = Counter(), defaultdict(Counter), scoring.ORDER
    lists = [(d, (t or "").encode().translate(LOWER).split()) for d, t, *_ in rows()]
    unseen = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 5 == 1
    for d, w in lists:
        if not unseen(d):
            words.update(w)
            words[None] += 1
            s = b"\xfe" * order + b" ".join(w) + b"\xff"
            for k in range(order, len(s)):
                for o in range(order + 1):
                    counts[s[k - o : k]][s[k]] += 1
    n, v = sum(words.values()), len(words)

    def log10(context, symbol):
        out, seen = 0.0, set()
        for o in range(order, -1, -1):
            here = counts.get(context[order - o :])
            live = {x: c for x, c in (here or {}).items() if x not in seen}
            if symbol in live:
                return out + math.log10((2 * live[symbol] - 1) / (2 * sum(live.values())))
            if live:
                out += math.log10(len(live) / (2 * sum(live.values())))
            seen |= set(here or ())
        return out - math.log10(256 - len(counts[b""]))

    expected = []
    for d, w in lists:
        s = b"\xfe" * order + b" ".join(w) + b"\xff"
        base = sum(math.log10((words.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None])
        expected.append((key(d), unseen(d), len(w) + 1, sum(x in words for x in [*w, None]), n, base, sum(log10(s[k - order : k], s[k]) for k in range(order, len(s)))))
    got = [(key(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in scoring.scored(docs, block=F.pmod(F.xxhash64("text"), F.lit(6)), buckets=buckets, salts=salts).collect()]
    for g, e in zip(sorted(got), sorted(expected), strict=True):
        assert g[:5] == e[:5]
        assert g[5:] == pytest.approx(e[5:], rel=1e-6)


def test_blocks_of_long_documents_are_cut(spark, tmp_path):
    texts = [("ab " * 400, "x")[k % 50 < 40] for k in range(300)]
    spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "d"))
    docs_, block = scoring.file_blocks(spark.read.parquet(str(tmp_path / "d")), rows=100, block_bytes=10_000)
    held = docs_.groupBy(block.alias("b")).agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("rows")).collect()
    assert sum(r.rows for r in held) == 300 and len(held) >= 9 and max(r.n for r in held) <= 2.5 * 10_000


# repeated strings


@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=8))
@settings(max_examples=80, deadline=None)
def test_suffix_arrays(texts):
    arrays = suffixes.suffix_arrays([np.array(t, np.int64) for t in texts])
    assert [a.tolist() for a in arrays] == [sorted(range(len(t)), key=lambda k: t[k:]) for t in texts]


@pytest.mark.parametrize("most_contexts", [256, 1])
def test_repeats_equal_brute_force(docs, spark, most_contexts):
    hashes = {(r.doc_id, r.text): r.th for r in docs.select("doc_id", "text", F.xxhash64("text").alias("th")).collect()}
    order = sorted({((*key(d), hashes[d, t]), t or "") for d, t, *_ in rows()})
    seen, kept = set(), {}
    for place, t in order:
        raw, gone = t.encode(), set()
        for k in range(len(raw) - 99):
            s = raw[k : k + 100]
            if s in seen:
                gone.update(range(k, k + 100))
            seen.add(s)
        kept[place[:2], t] = (len(raw), len(gone), sum(k - 1 not in gone for k in gone), bytes(x for k, x in enumerate(raw) if k not in gone))
    got = Counter((key(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.without_repeats(docs, most_contexts=most_contexts).collect())
    assert got == Counter((key(d), *kept[key(d), t or ""]) for d, t, *_ in rows())


@pytest.mark.parametrize("most_held", [5, 2_000_000])
def test_a_bucket_is_thinned_without_loss(spark, monkeypatch, most_held):
    """A passage that a third of the documents share, between words that differ: what a bucket holds stays small and the result is brute force's."""
    passage = prose(77, 45)
    texts = [f"{prose(300 + k, 12)} {passage} {prose(600 + k, 12)}" if k % 3 == 0 else prose(900 + k, 40) for k in range(90)]
    full = repeats._matched
    monkeypatch.setattr(repeats, "_matched", lambda length, most: full(length, most, most_held))
    seen, expected = set(), {}
    for d, t in enumerate(texts):
        raw, gone = t.encode(), set()
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone.update(range(k, k + 100))
            seen.add(raw[k : k + 100])
        expected[d] = bytes(x for k, x in enumerate(raw) if k not in gone)
    docs_ = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: bytes(r.kept) for r in repeats.without_repeats(docs_, most_contexts=4).collect()}
    assert got == expected and sum(map(len, got.values())) < 0.85 * sum(map(len, texts))


# language


def test_language_learns_and_rejects(spark):
    de, en = "der die das und nicht schön über", "the and of with that is you"
    data = [(k, " ".join(((de, en)[k % 2] + " ") * 5), ("de", "en")[k % 2], None, 0) for k in range(60)] + [(100, None, "de", None, 0), (101, "123 !?", "en", None, 0), (None, "the that", None, None, 0)]
    got = language.predicted(documents(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        if r.doc_id is None:
            assert r.lang_pred == "en"
        elif r.doc_id >= 100:
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == ("de", "en")[r.doc_id % 2] and 0.5 < r.score <= 1
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def naive_bayes(docs, unseen, bits=15):
    """doc -> (language, score) by counting in a dict: n-grams of 1 to 3 code points of the lower-cased text between blanks."""

    def buckets(text):
        codes = [ord(c) for c in f" {text.lower()} "]
        for at in range(len(codes)):
            h = 0
            for n, mix in enumerate((0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[: len(codes) - at]):
                h = (h ^ codes[at + n]) * mix & 0xFFFFFFFF
                h ^= h >> 15
                yield (h * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - bits

    counts, texts = defaultdict(Counter), Counter()
    for d, text, lang in docs:
        if text is not None and lang is not None and not unseen(d):
            counts[lang].update(buckets(text))
            texts[lang] += 1
    size = 1 << bits
    total = {x: sum(c.values()) + size / 2 for x, c in counts.items()}
    own = {x: sum((n + 0.5) / total[x] * math.log((n + 0.5) / total[x]) for n in c.values()) + (size - len(c)) * 0.5 / total[x] * math.log(0.5 / total[x]) for x, c in counts.items()}
    prior = {x: math.log((texts[x] + 1) / (sum(texts.values()) + len(texts))) for x in counts}
    out = []
    for d, text, _ in docs:
        if not text or not any(c.isalpha() for c in text):
            out.append((d, "und", 0.0))
            continue
        grams = list(buckets(text))
        sums = {x: sum(math.log((counts[x][g] + 0.5) / total[x]) for g in grams) for x in counts}
        best = max(sorted(sums), key=lambda x: sums[x] + prior[x])
        odds = 1 / sum(math.exp(min(50, sums[x] + prior[x] - sums[best] - prior[best])) for x in sums)
        out.append((d, best, odds * math.exp(min(0, sums[best] / len(grams) - own[best]))))
    return out


def test_language_equals_plain_naive_bayes(docs):
    unseen = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 4 == 2
    expected = sorted((key(d), lang, score) for d, lang, score in naive_bayes([(d, t, x) for d, t, x, *_ in rows()], unseen))
    got = sorted((key(r.doc_id), r.lang_pred, r.score) for r in language.predicted(docs).collect())
    for g, e in zip(got, expected, strict=True):
        assert g[:2] == e[:2] and g[2] == pytest.approx(e[2], rel=1e-3, abs=1e-9)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_held_out_languages_are_told(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").where("lang is not null")
    unseen = found.where("held_out").collect()
    assert len(unseen) > 150 and sum(r.lang_pred == r.lang for r in unseen) >= 0.99 * len(unseen)
    assert all(0 <= r.score <= 1 for r in unseen) and min(r.score for r in unseen) < 0.9


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables here")
def test_score_falls_for_what_was_not_learned(spark):
    learned = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    strange = ["Это простой русский текст о погоде и природе нашей страны.", "今天天气很好我们去公园散步吧大家一起来", "@@@ ### 123 a $$$ %%% 999", "<div><p>html</p></div>"]
    both = learned.unionByName(documents(spark, [(-1 - k, t, None, "s", len(t)) for k, t in enumerate(strange)]).select(learned.columns))
    found = language.cross_predicted(both, keep=("doc_id", "lang")).collect()
    assert max(r.score for r in found if r.doc_id < 0) < 0.05
    assert max(r.score for r in found if r.doc_id in (-1, -2)) < 0.02
    prose_ = [r for r in found if r.doc_id >= 0 and r.lang]
    assert sum(r.score > 0.02 and r.lang_pred == r.lang for r in prose_) >= 0.99 * len(prose_)


def test_no_document_is_judged_by_itself(spark):
    """A text in a language of its own, of which there is nothing else to learn from, is not told."""
    docs = documents(spark, [(k, prose(k, 80), "en", "s", 0) for k in range(20)] + [(99, "жизнь как чудо и река", "ru", "s", 0)])
    found = language.identify(docs, language.train(docs)).where("doc_id = 99").first()
    assert found.lang_pred == "ru"
    found = language.cross_predicted(docs, keep=("doc_id",)).where("doc_id = 99").first()
    assert found.lang_pred == "en" and found.score < 0.5


def test_language_without_labels(spark):
    assert {r.lang_pred for r in language.predicted(documents(spark, [(1, "text", None, None, 4)])).collect()} == {"und"}


# lines


def test_repeated_runs_go(spark):
    data = [(1, "a\nb\nc\nd", None, None, 0), (2, "x\nb\nc\n\ny", None, None, 0), (3, "a\nz", None, None, 0), (4, None, None, None, 0), (5, "q\nq\nq", None, None, 0), (None, "a\nb", None, None, 0)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.kept) for r in lines.without_repeated_runs(documents(spark, data)).collect()}
    assert got == {1: (4, 0, 0, "a\nb\nc\nd"), 2: (4, 2, 1, "x\n\ny"), 3: (2, 0, 0, "a\nz"), 4: (0, 0, 0, None), 5: (3, 2, 1, "q\n"), None: (2, 2, 1, "")}


def test_long_line_is_a_run(spark):
    line = " ".join(f"w{k}" for k in range(25))
    got = {r.doc_id: r.n_removed for r in lines.without_repeated_runs(documents(spark, [(1, f"p\n{line}", None, None, 0), (2, f"{line}\nq", None, None, 0)])).collect()}
    assert got == {1: 0, 2: 1}


# fingerprints


def test_fingerprints_equal_single_texts(docs, spark):
    hashes = {(r.doc_id, r.text): r.th for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("th")).collect()}
    order = sorted(((d is None, -(d or 0), hashes[d, t]), t or "", d) for d, t, *_ in rows())
    expected = []
    for k, (_, t, d) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        a, b, c = (fingerprints.fingerprints([x.encode()])[0] for x in (t, edited, following))
        expected.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.written(a), fingerprints.written(b), fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    for parts in (2, 7):
        got = Counter(tuple(r) for r in fingerprints.compared(docs, parts).collect())
        assert got == Counter(expected)


def plain_chunks(text):
    """Lengths of the chunks of ``text``, byte by byte: the gear hash of a place is a sum over the 32 bytes up to it."""
    gear, cuts, last = [int(x) for x in fingerprints._GEAR], [], 0
    for p in range(1, len(text) + 1):
        size = p - last
        h = sum(gear[text[p - 1 - k]] << k for k in range(32)) & 0xFFFFFFFF if p >= 32 else 0xFFFFFFFF
        if p == len(text) or size == fingerprints.MOST or (size >= fingerprints.WANTED and h >> 28 == 0) or (size >= fingerprints.LEAST and h >> 26 == 0):
            cuts.append(size)
            last = p
    return cuts


@given(st.lists(st.one_of(st.binary(max_size=700), st.integers(0, 40).map(lambda k: prose(k, 150).encode()), st.integers(1, 600).map(lambda n: b"a" * n)), min_size=1, max_size=4))
@settings(max_examples=40, deadline=None)
def test_chunks_equal_byte_by_byte_chunking(texts):
    for text, got in zip(texts, fingerprints.fingerprints(texts), strict=True):
        expected, at = Counter(), 0
        for n in plain_chunks(text):
            expected[xxhash.xxh3_64_hexdigest(text[at : at + n])] += n
            at += n
        assert got == dict(expected) and sum(got.values()) == len(text)
        assert fingerprints.likeness(got, got) == 1.0


def test_fingerprint_survives_a_shift():
    text = rows()[14][1].encode()
    a, b = fingerprints.fingerprints([text])[0], fingerprints.fingerprints([b"inserted " + text])[0]
    assert fingerprints.likeness(a, b) > 0.95 and fingerprints.read(fingerprints.written(a)) == a


# near-duplicates


def test_simhash_equals_brute_force(docs):
    def value(t):
        w = (t or "").encode().translate(LOWER).split()
        h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 4]), 42) for k in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    found = [(d, value(t)) for d, t, *_ in rows()]
    label = {f: f for _, f in found}
    for _ in label:
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for d, f in found:
        if d is not None:
            least[label[f]] = min(least.get(label[f], d), d)
    expected = Counter((d, f"{f:016x}", least.get(label[f])) for d, f in found)
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == expected


@pytest.mark.parametrize("entries", [100, 1 << 30])
@pytest.mark.parametrize("block", [2, 1024])
def test_no_link_is_missed(spark, entries, block):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = {int(b) for b in base}
    for b in base:
        for _ in range(6):
            v = int(b)
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    fps = spark.createDataFrame([(v.to_bytes(8, "little"),) for v in values], "fp binary")
    edges = simhash.linked(fps, simhash.exact_segments(4, entries), 1, 4, block=block)
    roots = {bytes(r.node): bytes(r.root) for r in components(edges).collect()}
    got = defaultdict(set)
    for v in values:
        raw = v.to_bytes(8, "little")
        got[roots.get(raw, raw)].add(v)
    label = {v: v for v in values}
    for _ in range(20):
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    expected = defaultdict(set)
    for v in values:
        expected[label[v]].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_one_of_each_keeps_one(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    texts = [r.text for r in found]
    assert len(texts) == len(set(texts)) and sum(not (t or "").strip() for t in texts) == 1
    assert rows()[20][1] in texts and rows()[21][1] not in texts


def variant(text, n, seed):
    """``text`` with ``n`` words replaced at about equal distances."""
    words = text.split()
    for k in range(n):
        words[(seed + (2 * k + 1) * len(words) // (2 * n)) % len(words)] = f"new{seed}x{k}"
    return " ".join(words)


@pytest.mark.parametrize("block", [2, 512])
def test_one_of_each_links_by_similarity_alone(spark, block):
    texts = []
    for base in range(30):
        text = prose(500 + base, 150 + 10 * base)
        texts += [text, *(variant(text, len(text.split()) * n // 1000, 7 + n) for n in (6, 14, 20, 26, 30, 36, 44))]
    texts += ["alpha beta", "Alpha  BETA", "", None]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    label, close, wide = list(range(len(texts))), 0, 0
    for a in range(len(texts)):
        for b in range(a):
            both, of = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            close, wide = close + (0.8 <= both / max(1, of) < 0.85), wide + (0.7 <= both / max(1, of) < 0.8)
            if 10 * both >= 8 * of:
                label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    assert close > 20 and wide > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.one_of_each(docs, block=block).collect()) == sorted(set(label))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


# archives


def test_archives_round_trip(spark):
    html = "<p>WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: response</p>"
    pages = spark.createDataFrame([(1, "u1", html), (2, "u\n2", html), (3, None, None), (4, "u4", ""), (5, "u5", "é"), (None, "u", html), (5, "u5", "é"), (6, "u6", html)], "page_id long, url string, html string").selectExpr("*", "1 as payload", "2 as n")
    got = collected(warc.archived(pages))
    digests = {r[0]: r[2] for r in got}
    assert digests[4] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    n = len(html)
    shown = [(a, b, d, e) for a, b, _, d, e in got]
    assert shown == [(1, n, "revisit", 6), (2, n, "revisit", 6), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 2, "response", None), (5, 2, "response", None), (6, n, "response", None), (None, n, "revisit", 6)]


@pytest.mark.parametrize("slots", [64, 1 << 23])
def test_archives_whatever_the_bitmap_says(spark, monkeypatch, slots):
    """A map of 64 bits takes most digests for shared: the join that follows decides."""
    monkeypatch.setattr(warc, "_SLOTS", slots)
    rng = np.random.default_rng(7)
    pages = [(int(k) if k else None, f"http://x/{n}", f"page {p}" if p < 150 else None if p < 160 else "") for n, (k, p) in enumerate(zip(rng.integers(0, 300, 400), rng.integers(0, 170, 400)))]
    largest = defaultdict(lambda: -1)
    sizes = Counter()
    for k, _, html in pages:
        largest[html or ""] = max(largest[html or ""], -1 if k is None else k)
        sizes[html or ""] += 1
    expected = Counter()
    for k, _, html in pages:
        top = largest[html or ""]
        revisit = sizes[html or ""] > 1 and top >= 0 and k != top
        expected[k, len(html or ""), "revisit" if revisit else "response", top if revisit else None] += 1
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived(df).collect()) == expected


def test_archives_are_read_in_pieces():
    import gzip

    record = lambda k, n: b"WARC/1.1\r\nWARC-Type: response\r\nX: %d\r\nContent-Length: %d\r\n\r\n" % (k, n) + b"\r\n\r\n" * (n // 4) + b"y" * (n % 4) + b"\r\n\r\n"
    sizes = [0, 3, 17, 70_000, 1, 0, 2_000_003]
    packed = gzip.compress(b"".join(record(k, n) for k, n in enumerate(sizes[:4]))) + gzip.compress(b"".join(record(k + 4, n) for k, n in enumerate(sizes[4:])))
    for step in (1000, 1 << 20):
        got = [(int(h[b"x"]), len(block)) for h, block in warc.parse(warc.inflated(packed, step))]
        assert got == list(enumerate(sizes))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse([record(0, 50)[:-10]]))


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    assert {r.page_id: r.record_type for r in warc.archived(pages, min_bytes=3).collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


# empty tables


def test_empty_tables_give_no_rows(spark, empty):
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        decontamination.contamination(empty, bench), packing.pack_documents(empty, queries.word_bpe()), scoring.scored(empty), repeats.without_repeats(empty), language.predicted(empty),
        lines.without_repeated_runs(empty), fingerprints.compared(empty), simhash.near_duplicates(empty), simhash.one_of_each(empty), warc.archived(pages), token_files.token_file_index(empty, queries.word_bpe()),
    ]
    assert [df.count() for df in results] == [0] * len(results)
