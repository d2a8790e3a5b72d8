"""Spelling variants, byte-level BPE and the prefix trie against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import byte_bpe, catalog, prefix_trie, spelling

SF_DIR = "/root/testdata/sf0.001"


# ---- spelling --------------------------------------------------------------------------------


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(words, min_length, min_count, times=10):
    counts = {w: n for w, n in Counter(words).items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in counts if v != w and _one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= times * counts[w]:
                form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form.get(w), counts.get(form.get(w)), root)
    return out


def _rows(frame):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in frame.collect()}


def test_variants_equal_comparing_all_pairs(spark):
    rng = random.Random(3)
    words = []
    for _ in range(250):
        w = "".join(rng.choice("abé") for _ in range(rng.randint(2, 6)))
        words += [w] * rng.choice([1, 2, 3, 30, 400])
    long_word = "".join(rng.choice("abc") for _ in range(66))
    for n, w in ((5000, long_word), (40, long_word[:30] + "x" + long_word[30:]), (3, long_word[:-1]), (2, long_word[:-2]), (2, "q" + long_word[1:])):
        words += [w] * n
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    assert _rows(spelling.variants(frame, 2, 2)) == _variants(words, 2, 2)


def test_runs_of_equal_letters_count_once(spark):
    words = ["aaaa"] * 2 + ["aaa"] * 50 + ["aaab"] * 3 + ["baaa"] * 2
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    assert _rows(spelling.variants(frame, 2, 2)) == _variants(words, 2, 2)


def test_document_words_and_damage(spark):
    rows = [(i, f"Éclairé wonderful{'x' * (i % 5)} short Naïveté1Another") for i in range(60)] + [(None, "wonderful"), (3, None), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("own"))
    expected = Counter()
    import re

    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            expected[low] += 1
    found = _rows(spelling.spelling_variants(frame))
    assert {w: f[0] for w, f in found.items()} == {w: n for w, n in expected.items() if len(w) >= 7 and n >= 2}
    assert any(n == 1 for n in expected.values())
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


# ---- BPE -------------------------------------------------------------------------------------


def _plain_bpe(ranks, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        pairs = [(ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)]
        rank, i = min(pairs)
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def _edge_texts():
    return ["", None, " ", "\n\n  x", "it's o'clock 12.5%", "<|endoftext|>", "é" * 50, "日本語のテキスト。", "a\x1cb\x85c", "🙂 x" * 20, "word " * 20000, "x" * 70000]


def test_ids_equal_merging_by_rank(spark):
    import regex

    path, pattern = catalog.packing_tokenizer()
    texts = [t for t in _edge_texts() if t is None or len(t) < 1000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("bytes", F.lit("own"))
    found = {r["doc_id"]: r["ids"] for r in byte_bpe.encoded(frame, path, pattern).collect()}
    ranks = byte_bpe.tokenizer(path, pattern)._mergeable_ranks
    for i, t in enumerate(texts):
        pieces = regex.findall(pattern, t or "")
        if "\x1c" in (t or ""):
            continue  # white space here, not there
        assert found[i] == [x for p in pieces for x in _plain_bpe(ranks, p.encode())], t


@pytest.mark.parametrize("size", [1, 3, 50, 1 << 16])
def test_cut_texts_have_the_ids_of_whole_ones(size):
    path, pattern = catalog.packing_tokenizer()
    encoding = byte_bpe.tokenizer(path, pattern)
    rng = random.Random(size)
    letters = list("ab's tre \n\t\r  12!?.'’\x1c\x85\xa0é你好。、한ıſ½́🙂")
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
        assert byte_bpe.encode_text(encoding, text, size).tolist() == encoding.encode_ordinary(text), text


def test_round_trip_of_whole_texts(spark):
    path, pattern = catalog.packing_tokenizer()
    rows = [(i, t) for i, t in enumerate(_edge_texts())] + [(0, ""), (None, "tail")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "n_tokens": F.lit("own")})
    found = byte_bpe.round_trip_digests(frame, path, pattern).collect()
    want = Counter((d, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert Counter((r["doc_id"], r["decoded_sha256"]) for r in found) == want
    ids = byte_bpe.tokenizer(path, pattern).encode_ordinary(_edge_texts()[10])
    digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert [(r["n_tokens"], r["ids_sha256"]) for r in found if r["doc_id"] == 10] == [(len(ids), digest)]
    assert byte_bpe.round_trip_digests(frame.limit(0), path, pattern).count() == 0


# ---- trie ------------------------------------------------------------------------------------


def test_findclose_equals_a_stack():
    rng = random.Random(5)
    for size in (1, 2, 40, 300, 5000):
        opens, depth, left = [True], 1, size - 1
        while left or depth > 1:
            up = left > 0 and (depth == 1 or rng.random() < (0.9 if size > 1000 and left > size // 2 else 0.5))
            opens.append(up)
            depth += 1 if up else -1
            left -= up
        opens.append(False)
        stack, close = [], {}
        for i, up in enumerate(opens):
            if up:
                stack.append(i)
            else:
                close[stack.pop()] = i
        at = np.flatnonzero(opens)
        assert prefix_trie.Parentheses(np.array(opens)).findclose(at).tolist() == [close[i] for i in at.tolist()]


def _rebuilt(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    return out


def _trie(rebuilt):
    members = {}
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), set()).add(c)
    rows = {}
    for node, ms in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in ms if len(rebuilt[c]) == len(node))))
        rows[min(ms), len(node)] = (
            min(members[node[:-1]]) if node else None, len(ms), len(children), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return rows


def _nodes(frame):
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = frame.collect()
    found = {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def _conversations():
    rng = random.Random(9)
    rows = []
    for c in range(70):
        for turn in range(rng.randint(1, 6)):
            same = rng.random() < 0.7
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", None]) if not same else "user", "é" * turn if same else rng.choice("abc")))
    rows += [(200 + i, t, "user", "copy") for i in range(25) for t in range(3)]
    rows += [(300, 1, "user", "tie b"), (300, 1, "user", "tie a"), (300, 1, None, "tie a"), (300, 1, "user", "tie a"), (None, 0, "user", "nobody"), (304, 0, None, None)]
    rows += [(401, t, "user", f"turn {t}") for t in range(2)]  # its first turns are those of no conversation
    return rows


@pytest.mark.parametrize("turns", [1, 5, 37, None])
def test_trie_over_many_shards(spark, monkeypatch, turns):
    """Shards of a turn or a few: spines of all depths, copies over many shards, lists in pieces."""
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 4)
    rows = _conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("size", F.lit("own"))
    assert _nodes(prefix_trie.family_trie(frame, turns)) == _trie(_rebuilt(rows))


def test_trie_of_plain_conversations_and_of_none(spark):
    rows = [(2, 0, "u", "a"), (2, 1, "a", "b"), (5, 0, "u", "a"), (7, 3, "u", "a"), (7, 4, "a", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    paths = {2: [("u", "a"), ("a", "b")], 5: [("u", "a")], 7: [("u", "a"), ("a", "b")]}
    assert _nodes(prefix_trie.conversation_trie(frame)) == _trie(paths)
    assert prefix_trie.family_trie(frame.limit(0)).count() == 0
