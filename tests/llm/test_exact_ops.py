"""Operators with one right result, against plain versions: token files, packing, decontamination, search, personal data."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, ids, packing, pii, tokenfile, topk
from tessera.session import new_scratch_path

#: Nulls, empties, repeats, ties and one long text; with further columns whose names the operators use inside.
ROWS = [(None, "no id here"), (3, None), (3, None), (1, ""), (7, "a  b\n\nc  "), (7, "a  b\n\nc  "), (2, "½ Ⅷ 日本語 é x"),
        (9, "It's one. Two! " * 900), (2**60 + 1, "big id."), (5, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    for name in ("row", "key", "ids", "score", "start", "class", "hash", "label"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(ids.default_path())


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def plain_ids(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_ids_equal_the_library(tokenizer):
    enc = ids.IdEncoder(ids.default_path())
    rng = np.random.default_rng(3)
    letters = list(" \n\tabAé.,'1½ 日\x1c-s_")
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(3000)]
    texts += ["", " ", "  a", "a ", "a \nb", "it's we'll 's", "x <|endoftext|> y", "  ok", "🙂 a 🙂"]
    assert [enc.encode(t).tolist() for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("limit", [4, 5, 16])
def test_code_lengths_are_optimal_within_the_limit(limit):
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 0, 55, 89])
    lengths = tokenfile.code_lengths(counts, limit)
    used = lengths[counts > 0]
    assert used.max() <= limit and lengths[9] == 0 and sum(2.0 ** -used) == 1.0
    if limit == 16:  # Huffman's own cost: sum of all merged weights
        heap, cost = sorted(counts[counts > 0].tolist()), 0
        while len(heap) > 1:
            cost += heap[0] + heap[1]
            heap = sorted([heap[0] + heap[1], *heap[2:]])
        assert (lengths * counts).sum() == cost


def test_bits_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 127, 128, 129, 5000):
        values = rng.zipf(1.3, n).clip(1, 3000).astype(np.int64)
        lengths = tokenfile.code_lengths(np.bincount(values))
        bits, marks = tokenfile.encode_bits(values, tokenfile.canonical_codes(lengths), lengths)
        assert tokenfile.Decoder(lengths).decode(bits, marks.tobytes(), n).tolist() == values.tolist()


def test_token_files_round_trip(spark, docs, tokenizer):
    path = new_scratch_path(spark, "test-token-files")
    tokenfile.write_token_files(docs, path)
    got = sorted(((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in tokenfile.read_token_files(spark, path).collect()))
    want, start = [], 0
    for doc_id, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        own = plain_ids(tokenizer, text, 2)
        want.append((start, doc_id, len(own), np.array(own, "<u4").tobytes()))
        start += len(own)
    assert got == want
    path = new_scratch_path(spark, "test-token-files")
    tokenfile.write_token_files(empty(spark), path)
    assert tokenfile.read_token_files(spark, path).count() == 0


def test_best_cuts_against_every_plan():
    rng = np.random.default_rng(2)

    def cost(pos, pen, cuts, window, each):
        total = 0
        for i, j in zip(cuts, cuts[1:]):
            size = pos[j] - pos[i]
            total += each + pen[j] + (0 if size & (size - 1) == 0 else window - size)
        return total

    for _ in range(60):
        window, each = 16, int(rng.integers(0, 9))
        pos = np.concatenate([[0], np.cumsum(rng.integers(1, 12, 9))]).tolist()
        pen = [0, *rng.integers(0, 9, 9).tolist()]
        best = [0] + [10**9] * 9
        for j in range(1, 10):
            for i in range(j):
                if pos[j] - pos[i] <= window:
                    best[j] = min(best[j], best[i] + cost(pos, pen, [i, j], window, each))
        cuts = packing.best_cuts(pos, pen, window, each)
        assert cuts[0] == 0 and cuts[-1] == 9 and cost(pos, pen, cuts, window, each) == best[9]


def test_packing_places_each_id_once(spark, docs, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 700)
    rows = packing.pack_documents(docs, window=64).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 64
    texts = defaultdict(list)
    for doc_id, text in ROWS:
        texts[doc_id].append(np.array(plain_ids(tokenizer, text, 0), "<u4").tobytes())
    for doc_id, wanted in texts.items():
        own = sorted(pieces[doc_id], key=lambda r: (r.start, r.sequence_id, r.offset))
        if len(wanted) == 1:
            assert b"".join(bytes(r.ids) for r in own) == wanted[0] and own[0].doc_tokens == len(wanted[0]) // 4
        else:  # equal rows: every id as often as there are rows
            assert sum(r.length for r in own) == sum(map(len, wanted)) // 4
    full = sum(sum(n for _, n in p) for p in sequences.values())
    assert full / (64 * len(sequences)) > 0.8
    assert packing.pack_documents(empty(spark)).count() == 0


def test_decontamination_against_brute_force(spark):
    rng = np.random.default_rng(4)
    vocab = [f"w{k}" for k in range(40)]
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(1, say(20)), (2, say(13)), (10, "W3, w4"), (11, "w3 w4"), (4, None), (5, " ,. "), (None, say(14)), (6, say(30)), (6, say(15))]
    long_item = items[7][1]
    docs = [(1, say(30) + " " + items[0][1] + " " + say(5)), (2, items[1][1].upper()), (3, None), (3, None), (4, ""), (5, "é w3.w4 é"),
            (None, long_item + say(400)), (7, say(12)), (8, " ".join(long_item.split()[5:19])), (8, " ".join(long_item.split()[5:19]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("hash", F.lit(1)).withColumn("key", F.lit("k"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def brute(text):
        # the pattern leaves capitals out, so lower-casing comes first
        ws = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        hit, found = set(), set()
        for item, t in items:
            iw = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
            n = min(13, len(iw))
            for i in range(len(iw) - n + 1 if n else 0):
                for j in range(len(ws) - n + 1):
                    if ws[j: j + n] == iw[i: i + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
        return len(ws), len(hit), sorted(x for x in found if x != "None")

    got = decontam.contamination(d, b).collect()
    want = sorted((str(i), *map(str, brute(t))) for i, t in docs)
    assert sorted((str(r.doc_id), str(r.n_words), str(r.n_hit), str([x for x in r["items"] if x is not None])) for r in got) == want
    assert decontam.contamination(d, b.limit(0)).filter("n_hit > 0").count() == 0
    assert decontam.contamination(d.limit(0), b).count() == 0


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [(k, rng.integers(-9, 10, 6).tolist()) for k in range(300)]
    vectors += [(40, [1] * 6), (301, vectors[20][1]), (302, vectors[20][1]), (60, None), (None, [1] * 6), (320, [1, 2]), (303, [3, 4]),
                (340, []), (305, [None] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>").withColumn("row", F.lit(0)).repartition(4)
    got = defaultdict(list)
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, 20).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    valid = [(i, v) for i, v in vectors if v is not None and None not in v]  # a row without an id is a candidate
    want = defaultdict(list)
    for n, (q, v) in enumerate(valid):
        if q is not None and q % 20 == 0:
            scores = sorted(((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(valid) if m != n and len(w) == len(v)), key=lambda s: (s[0], s[1] is None, s[1]))[:20]
            want[q] += [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items() if v}
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_hold_beside_far_pivots():
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.integers(-3, 4, (200, 5)), rng.integers(-3, 4, (200, 5)) * 100_000])
    pivots = np.concatenate([np.zeros((1, 5)), v[390:] * 1.0])
    p = np.sqrt(((v[:, None, :] - pivots) ** 2).sum(2))
    assert (topk.upper_bounds({"p": p}, {"p": p}) >= v @ v.T).all()


def test_block_pairs_are_dealt_by_the_pair(spark):
    """No join on the vectors' length alone: it is the same for most rows."""
    rows = spark.range(4000).select(F.col("id").alias("vec_id"), F.array(F.col("id") % 7, F.col("id") % 11).alias("v"))
    found = topk.top_k(rows, F.col("vec_id") % 20 == 0, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(dim#\d+, x#\d+L?, q#\d+L?", plan) and "Cartesian" not in plan and "NestedLoop" not in plan
    got = {(r.query_id, r["rank"]): r.score for r in found.collect()}
    assert len(got) == 600


def test_other_tokenizer_files_give_the_librarys_ids():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    enc, own = ids.IdEncoder(path), Tokenizer.from_file(path)
    texts = ["Plain text, with punctuation!", "two  spaces\nand lines", "été 日本 it's 12345", "", " lead"]
    assert not enc.cuts and ids.IdEncoder(ids.default_path()).cuts
    assert [enc.encode(t).tolist() for t in texts] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_runs_of_digits_are_no_address():
    assert pii.base_spans("0" * 5000 + ".1.2.3 " + "9" * 5000 + ".1.2.3 0.0.0.0 256.1.1.1 00255.1.1.1")[0][0] == 1
    assert len([s for s in pii.base_spans("0" * 5000 + ".1.2.3 " + "9" * 5000 + ".1.2.3 256.1.1.1") if s[0] == 1]) == 1


def test_unusable_components_take_no_part(spark):
    df = spark.createDataFrame([(0, [1.0, float("nan")]), (20, [float("inf"), 1.0]), (40, [1.0, None]), (60, [1.0, 2.0])],
                               "vec_id long, v array<double>")
    assert [r.vec_id for r in df.filter(topk.usable("v")).collect()] == [60]


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((k, m.start(), m.end()))
    return out


def test_base_patterns_against_plain_regex():
    rng = np.random.default_rng(6)
    letters = list("ab@@..--0123456789+() %_é\n")
    texts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(20000)]
    texts += ["@a.b@c.d", "x@a.b@c.d", "1.2.3.4.5.6.7.8", "001.002.003.0004", "4111 1111-1111 1111", "+1 (414) 555-7134 x"]
    for t in texts:
        assert sorted(pii.base_spans(t)) == plain_base(t), t


def test_pruned_viterbi_equals_full_decoding():
    tagger = pii.Tagger(pii.field())
    rng = np.random.default_rng(7)
    words = [w for line, _ in pii.labelled_table() for w in line] + ["plain", "words", "(555)", "[at]", "::1", "12-34"]
    lists = [rng.choice(words, rng.integers(0, 40)).tolist() for _ in range(300)]
    for tags, ws in zip(tagger.tag(lists), lists):
        if ws:
            p = np.array([0, *map(tagger.profile, ws), 0])
            unary = tagger.tables[p[1:-1], 0] + tagger.tables[p[:-2], 1] + tagger.tables[p[2:], 2]
            full = pii.viterbi(unary[None], np.array([len(ws)]), tagger.crf.move)[0]
            assert tags == {k: int(v) for k, v in enumerate(full) if v}


def test_field_finds_what_patterns_miss_and_leaves_plain_text():
    tagger = pii.Tagger(pii.field())
    new = ["please call (318) 555-0177 soon", "mail to rob.k [at] site [dot] net please", "the server 2001:db8::42 is down"]
    for base, spans in pii.all_spans(new, tagger):
        assert not base and len(spans) == 1
    plain = [*pii.PLAIN_LINES, "The year 2024 had 366 days.", "A plain line, with words; and more words!"]
    assert all(not spans for _, spans in pii.all_spans(plain, tagger))


def test_personal_spans_and_redaction(spark):
    rows = [(1, "write a.b@c.org or call +1 (414) 555-7134."), (2, None), (2, None), (None, ""), (4, "é 12.71.76.174 x " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "spans", F.lit("mine"))
    got = pii.personal_spans(df).select("doc_id", pii.listed("base").alias("b"), pii.listed("spans").alias("s")).collect()
    want = {str(i): ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in plain_base(t or "")) for i, t in rows}
    assert len(got) == 5 and all(r.b == want[str(r.doc_id)] and set(r.b.split(",")) <= set(r.s.split(",")) for r in got)
    out = pii.redact(df)
    assert out.columns == df.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text == "write [email] or call [phone]." and by[1].n_chars == len(by[1].text)
    assert by[2].text is None and by[2].n_chars is None and by[None].text == "" and by[1].spans == "mine"
    assert pii.personal_spans(df.limit(0)).count() == 0 and pii.redact(df.limit(0)).count() == 0


def test_digest_of_no_spans():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442") and zlib.crc32(b"") == 0
