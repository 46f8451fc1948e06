"""Alignment, spelling variants and fingerprints against brute force, and on odd tables."""

import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helixframe.llm import alignment, fingerprints, spelling
from helixframe.llm.queries import QUERIES

from .helpers import ODD, ODD_SCHEMA

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=B)


# --- alignment ------------------------------------------------------------------------------------------


def plain_alignment(text, first, second):
    """(n_a, n_b, groups, links, digest) by walking both token lists; None without tokens."""
    if not text:
        return None
    byte = alignment._byte_of()
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    of_a = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
    of_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
        return None
    spans = []
    for parts in (of_a, of_b):
        at, own = 0, []
        for p in parts:
            own.append((at, at + len(p)))
            at += len(p)
        spans.append(own)
    links, j = [], 0
    for i, (low, high) in enumerate(spans[0]):
        while spans[1][j][1] <= low:
            j += 1
        k = j
        while k < len(b) and spans[1][k][0] < high:
            links.append((a[i], b[k]))
            k += 1
    groups, i, j = [], 0, 0
    for cut in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        x = next(k for k in range(i, len(a)) if spans[0][k][1] == cut) + 1
        y = next(k for k in range(j, len(b)) if spans[1][k][1] == cut) + 1
        groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
        i, j = x, y
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def scored(plain):
    """What the query returns, from ``plain_alignment`` of every row."""
    count = collections.Counter(p for v in plain if v for p in set(v[3]))
    best = collections.defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(v[0], v[1], v[2], len(v[3]), sum(count[p] == best[p[0]] for p in v[3]), sum(count[p] for p in v[3]), v[4]) if v else (0, 0, 0, 0, 0, 0, "") for v in plain]


def row(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def test_alignment_equals_walking_tokens(spark, docs, libraries):
    got = {r.doc_id: row(r) for r in QUERIES["op11_alignment"](spark, SF).collect()}
    want = scored([plain_alignment(t, *libraries) for _, t in docs])
    assert got == dict(zip([d for d, _ in docs], want)) and sum(w[0] > 0 for w in want) > 150


def test_alignment_of_long_texts_over_tasks(spark, docs, libraries):
    """Ranges of a few bytes: texts with and without blanks, in several scripts, reduced over many levels, and blocks of few pairs."""
    rnd = random.Random(3)
    mixed = ["".join(rnd.choice(["word ", "née ", "世界 ", "x", "  ", "\n", "1234 ", "don't ", "-- ", " ", "\x1c"]) for _ in range(900)) for _ in range(4)]
    rows = [(i, t) for i, t in enumerate([*mixed, "a" * 3000, "ab" * 900 + " c " * 300, "▁ marks ▁ are no blanks " * 40, "", None, "<|endoftext|> </s> <0x41> " * 30, *(t for _, t in docs[:12])])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: row(r) for r in alignment.align(df, A, B, public_tokenizers.PATTERN, chunk=200, block=300).collect()}
    assert got == dict(zip([i for i, _ in rows], scored([plain_alignment(t, *libraries) for _, t in rows])))


def test_fragments_are_a_monoid(docs):
    """Any cut of the tokens, at any byte, composed in any order, gives the whole."""
    t = alignment.both(A, B, public_tokenizers.PATTERN)
    rnd = random.Random(5)
    same = lambda x, y: all(np.array_equal(p, q) if isinstance(p, np.ndarray) else p == q for p, q in zip(alignment._flat(x), alignment._flat(y)))
    for _, text in [d for d in docs if d[1]][:6] + [(0, "Ünïcödé wörds 世界 " * 20)]:
        text = text[:600]
        a, b, ok = next(t.encode([text]))
        ea, eb = np.cumsum(t.size_a[a]), np.cumsum(t.size_b[b])
        cuts = sorted(rnd.sample(range(1, int(ea[-1])), 7))
        parts = []
        for low, high in zip([0, *cuts], [*cuts, int(ea[-1])]):
            x, y = ((e - s[i] >= low) & (e - s[i] < high) for e, s, i in ((ea, t.size_a, a), (eb, t.size_b, b)))
            parts.append(t.measure(alignment.Tokens(a[x], ea[x], b[y], eb[y])))
        whole = t.measure(alignment.Tokens(a, ea, b, eb))
        for _ in range(5):
            left = list(parts)
            while len(left) > 1:
                i = rnd.randrange(len(left) - 1)
                left[i : i + 2] = [t.compose(left[i], left[i + 1])]
            assert same(left[0], whole)
        assert same(t.compose(alignment.UNIT, whole), whole) and same(t.compose(whole, alignment.UNIT), whole)
        assert not t.compose(whole, alignment.UNIT._replace(same=False)).same and ok


def test_merges_of_the_ranks_are_those_of_the_vocabulary(libraries):
    """The merges by rank give the same ids as the tokenizer's own file."""
    t, rnd = alignment.both(A, B, public_tokenizers.PATTERN), random.Random(8)
    texts = ["".join(rnd.choice(["the", "ing ", " ", "'s", "Zx", "é", "\n", "12", "!?", "世", "\t "]) for _ in range(rnd.randrange(60))) for _ in range(300)]
    for x in texts:
        assert t.first.encode_ordinary(" " + x) == libraries[0].encode(" " + x, add_special_tokens=False).ids


# --- spelling variants ----------------------------------------------------------------------------------


def plain_variants(rows):
    import re

    count = collections.Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 6
    n = {w: k for w, k in count.items() if k >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w in n:
        close = [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)]
        top = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = top if top and n[top] >= 5 * n[w] else None
        out[w] = len(close)
    root = lambda w: w if form[w] is None else root(form[w])
    return {w: (form[w], root(w), n[w], out[w], n[form[w]] if form[w] else None) for w in n}


def test_variants_equal_all_pairs(spark):
    """Words of few letters, so that most have many neighbours, with indexes and tasks of a few words; chains of forms; hot halves."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randrange(5, 9))) for _ in range(60)] + [f"aaaaaa{c}" for c in "bcdefghijkl"]
    chain = ["stretch", "stretchs", "stretchss", "stretchsss"]
    text = [" ".join(rnd.choice(words) for _ in range(90)) for _ in range(30)] + [" ".join([w] * n) for w, n in zip(chain, (800, 150, 28, 5))]
    rows = [(i, t.title() if i % 3 == 0 else t) for i, t in enumerate(text)] + [(None, "aaaaaab, AAAAAAB; É"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain_variants(rows)
    assert want["stretchsss"][1] == "stretch" and max(v[3] for v in want.values()) > 8
    for indexed, asked in ((4096, 16384), (5, 7), (1, 1)):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(df, indexed=indexed, asked=asked).collect()}
        assert got == want


def test_position_index():
    rnd = random.Random(2)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 8))) for _ in range(150)})
    index = spelling.PositionIndex(words)
    for q in words + ["", "x", "abababababab"]:
        want = {w for w in words if w != q and (len(w) == len(q) and sum(x != y for x, y in zip(w, q)) == 1 or abs(len(w) - len(q)) == 1 and any(max(w, q, key=len)[:i] + max(w, q, key=len)[i + 1 :] == min(w, q, key=len) for i in range(8)))}
        assert sorted(index.near(q)) == sorted(want)


# --- fingerprints ---------------------------------------------------------------------------------------


def stretches(text):
    out = collections.Counter()
    for p in text.split("\n"):
        if p:
            out.update([p] if len(p) < fingerprints.WIDTH else [p[i : i + fingerprints.WIDTH] for i in range(len(p) - fingerprints.WIDTH + 1)])
    return out


def exact_likeness(x, y):
    if sorted(p for p in x.split("\n") if p) == sorted(p for p in y.split("\n") if p):
        return 1.0
    a, b = stretches(x), stretches(y)
    most = max(sum(v * v for v in a.values()), sum(v * v for v in b.values()))
    return sum(n * b[k] for k, n in a.items()) / most if most else 0.0


def test_fingerprints_of_documents_and_edits(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op13_fingerprints"](spark, SF).collect()}
    texts = [t or "" for _, t in docs]
    assert len(got) == len(docs)
    errors, equal = [], collections.defaultdict(set)
    for (d, _), own, after in zip(docs, texts, texts[1:] + texts[:1]):
        r, half = got[d], len(own) // 2
        changed = own[: len(own) - half] + after[:half]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        errors += [r.near_edited - exact_likeness(own, changed), r.near_next - exact_likeness(own, after)]
        equal[own].add(r.fingerprint)
        equal[changed].add(r.edited_fingerprint)
    assert all(len(x) == 1 for x in equal.values()) and len({next(iter(x)) for x in equal.values()}) == len(equal)
    # the standard error of an estimate is 1 / sqrt(LANES), about 0.044
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and np.abs(errors).max() < 0.25


def test_fingerprints_add_up():
    rnd = random.Random(7)
    lines = ["".join(rnd.choice("abcdé世 ") for _ in range(rnd.choice([1, 3, 15, 16, 17, 40, 900]))) for _ in range(40)]
    whole = fingerprints.packed(fingerprints.vector("\n".join(lines)))
    mixed = lines[::-1]
    assert fingerprints.packed(fingerprints.vector("\n\n".join(mixed))) == whole
    kept = fingerprints.packed(fingerprints.vector("\n".join(lines[:25])))
    assert fingerprints.inserted(kept, "\n".join(lines[25:])) == whole and fingerprints.deleted(whole, "\n".join(lines[25:])) == kept
    assert fingerprints.likeness(whole, whole) == 1.0 and 0.0 <= fingerprints.likeness(whole, kept) < 1.0
    zero = fingerprints.packed(fingerprints.vector(None))
    assert zero == bytes(fingerprints.SIZE) == fingerprints.deleted(whole, "\n".join(lines)) and fingerprints.likeness(zero, whole) == 0.0


def test_windows_of_long_paragraphs(monkeypatch):
    text = "".join(random.Random(1).choice("abc ") for _ in range(5000)) + "\nshort\n" + "x" * 777
    want = fingerprints.packed(fingerprints.vector(text))
    for window in (16, 100, 1000):
        monkeypatch.setattr(fingerprints, "WINDOW", window)
        assert fingerprints.packed(fingerprints.vector(text)) == want


def test_next_document_over_ranges(spark):
    """Few and many ranges, repeated and null ids, one row, none."""
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 7, *range(-40, 40)]), f"text {i}") for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7).withColumn("next_text", F.lit("other"))
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))
    want = sorted((a[1], b[1]) for a, b in zip(order, order[1:] + order[:1]))
    for parts in ("1", "4", "60"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert sorted((r.text, r.next_text) for r in fingerprints.with_next(df.select("doc_id", "text"), ["text"]).collect()) == want
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    one = fingerprints.edited(df.where("text = 'text 3'")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and fingerprints.edited(df.limit(0)).count() == 0


def test_no_tables_are_left_over(spark, tmp_path, monkeypatch):
    """What stays in the shared folder is what a result reads; the pipeline's last stage reads one table."""
    import os

    import corpus_pipeline
    from helixframe.llm import common

    root = tmp_path / "shared"
    root.mkdir()
    monkeypatch.setattr(common, "shared_dir", lambda spark: str(root))
    tables = lambda: sorted(x for x in os.listdir(root) if x.startswith("table-"))
    for run, most in ((lambda: QUERIES["op11_alignment"](spark, SF), 2), (lambda: QUERIES["op12_spelling"](spark, SF), 2), (lambda: QUERIES["op13_fingerprints"](spark, SF), 0), (lambda: corpus_pipeline.run(spark, SF), 1)):
        before = tables()
        assert run().count() > 0
        assert len(set(tables()) - set(before)) <= most


# --- odd tables -----------------------------------------------------------------------------------------


def test_odd_tables(spark, libraries):
    odd = spark.createDataFrame(ODD, ODD_SCHEMA).withColumns({c: F.lit(1) for c in ("row", "block", "pair", "word", "n", "near", "print", "next_text")})
    none = odd.limit(0)
    aligned = alignment.align(odd, A, B, public_tokenizers.PATTERN, chunk=5000).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted([(r.doc_id, *row(r)) for r in aligned], key=key) == sorted([(d, *v) for (d, *_), v in zip(ODD, scored([plain_alignment(t, *libraries) for _, t, *_ in ODD]))], key=key)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(odd, min_length=4).collect()}
    assert got["word"] == (None, "word", 30000 if zlib.crc32(b"8:word") % 199 else 0, 0, None)
    prints = fingerprints.edited(odd).collect()
    assert sorted(r.n_chars for r in prints) == sorted(len(t or "") for _, t, *_ in ODD)
    assert len({r.fingerprint for r in prints if r.doc_id == 4}) == 1
    assert alignment.align(none, A, B, public_tokenizers.PATTERN).count() == spelling.spelling_variants(none).count() == fingerprints.edited(none).count() == 0
