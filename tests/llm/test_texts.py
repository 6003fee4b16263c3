"""Encoding, line dedup, fingerprints, language model, toxicity, personal data and packing against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import WORDS, awkward, frame, lower, prose, tokens

from rillstone.llm import bpe, lines, lm, merkle, packing, pii, toxicity
from rillstone.llm.text import words as text_words

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
ODD = ["a  b", "  x \n\n y<|endoftext|>", "　 z", "it's 'll ½²　x", "\x1c a", "ab" * 9000, " " * 9000 + "x", "é" * 70000]


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_bpe(spark):
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(RANKS), special_tokens={})
    rows = awkward() + [(500 + i, t) for i, t in enumerate(ODD)]
    df = frame(spark, rows)
    ids = [encoding.encode_ordinary(t or "") for _, t in rows]
    want = [
        (r[0], len(i), sha(np.array(i, dtype="<u4").tobytes()), sha((r[1] or "").encode())) for r, i in zip(rows, ids)
    ]
    assert order(bpe.round_trip(df, RANKS, PATTERN).collect()) == order(want)
    back = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert order((r[0], bytes(r[1])) for r in back.collect()) == order((i, (t or "").encode()) for i, t in rows)


def test_parts_are_safe():
    rng = random.Random(1)
    codec = bpe.Codec.of(RANKS, PATTERN)
    for _ in range(200):
        text = "".join(rng.choice([*WORDS, " ", "  ", "\n", " \n", "'s", "½", "\x1c", " "]) for _ in range(80))
        cut = list(bpe.parts(text, 7))
        assert "".join(cut) == text
        assert sum((codec.encoding.encode_ordinary(p) for p in cut), []) == codec.encoding.encode_ordinary(text)


def test_long_white_space_is_one_piece():
    """Cut at every run of three or more, the ids are those of the pattern on the whole text."""
    rng = random.Random(6)
    codec = bpe.Codec.of(RANKS, PATTERN)
    for _ in range(400):
        text = "".join(rng.choice([*WORDS, " ", "    ", "\n\n", " \n  ", "\x85\xa0 ", "\u3000\u2003", "\x1c", "'s"]) for _ in range(40))
        cut = list(bpe.stretches(text, 2))
        assert "".join(t for t, _ in cut) == text
        ids = [(codec.whole_encoding() if one else codec.encoding).encode_ordinary(t) for t, one in cut]
        assert sum(ids, []) == codec.encoding.encode_ordinary(text)


def test_a_million_blanks(spark, tmp_path):
    """Texts on which the library's pattern gives up: the ids are those of the other library."""
    from tokenizers import Tokenizer

    from rillstone.llm.queries import op2_byte_bpe, op10_best_fit_packing

    n = 1_000_000
    texts = [" " * n, "\n" * n, " \n" * n, "\t \r\n\u3000" * (n // 4), "a" + " " * n + "b", "\n" * n + " é", "x <|endoftext|>" + " " * n]
    reference, codec = Tokenizer.from_file(JSON), bpe.Codec.of(JSON, PATTERN, added=True)
    for t in texts:
        assert codec.encode(t).tolist() == reference.encode(t, add_special_tokens=False).ids
    frame(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    done = {r["doc_id"]: r for r in op2_byte_bpe(spark, str(tmp_path)).collect()}
    assert {i: r["decoded_sha256"] for i, r in done.items()} == {i: sha(t.encode()) for i, t in enumerate(texts)}
    sizes = op10_best_fit_packing(spark, str(tmp_path)).groupBy("doc_id").sum("length").collect()
    want = {i: len(reference.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert {r[0]: r[1] for r in sizes} == want


def line_key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def test_lines(spark):
    rows = awkward()
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in split for k in {line_key(x) for x in ls})
    common = {k for k, n in seen.items() if k and n >= 10}
    assert common
    want = []
    for i, ls in split:
        stay = [x for x in ls if line_key(x) not in common]
        want.append((i, len(ls), len(ls) - len(stay), sha("\n".join(stay).encode())))
    df = frame(spark, rows)
    assert order(lines.digests(df).collect()) == order(want)
    kept = lines.without_common_lines(df)
    assert kept.columns == df.columns
    assert {len(r["text"]) == r["n_chars"] for r in kept.collect()} == {True}
    assert lines.digests(frame(spark, [])).count() == 0


def test_hot_shards_are_copied(spark, monkeypatch):
    monkeypatch.setattr(lines, "PROBES", 20)
    monkeypatch.setattr(lines, "SHARD_KEYS", 50)
    rows = awkward()
    df = frame(spark, rows)
    hit = lines.drop_common_lines(df).where("n_dropped > 0").select("row.doc_id").collect()
    assert len(hit) == 12


def test_shards_without_lines(spark, monkeypatch):
    """Few lines in many shards: the number of shards is the one they were dealt by."""
    monkeypatch.setattr(lines, "SHARD_KEYS", 1)
    rows = [(i, f"same\nown {i % 3}\nother") for i in range(12)]
    got = {r["doc_id"]: r["n_dropped"] for r in lines.digests(frame(spark, rows), least=10).collect()}
    assert got == {i: 2 for i in range(12)}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    index = lines.PerfectHash.over(keys)
    assert sorted(index.slot(keys).tolist()) == list(range(len(keys)))


def test_fingerprints(spark):
    rows = awkward()
    got = merkle.with_next(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    named = sorted([r for r in set(rows) if r[0] is not None], key=lambda r: -r[0])
    following = {r: named[i + 1] if i + 1 < len(named) else None for i, r in enumerate(named)}
    for r in got:
        if r["doc_id"] is None or r["doc_id"] == named[-1][0]:
            continue
        text, nxt = next(((t or ""), following[i, t][1] or "") for i, t in named if i == r["doc_id"])
        edited = merkle.edited(text, nxt)
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited.encode()))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (merkle.fingerprint(text), merkle.fingerprint(edited))
        assert r["near_next"] == merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(nxt))
    # After the last document comes the first.
    rows = [(i, f"text number {i}") for i in range(20)]
    last = merkle.with_next(frame(spark, rows)).where("doc_id = 0").first()
    assert last["edited_sha256"] == sha(merkle.edited(rows[0][1], rows[19][1]).encode())
    alone = merkle.with_next(frame(spark, [(1, "a b c")])).first()
    assert alone["near_next"] == 1.0
    assert merkle.with_next(frame(spark, [])).count() == 0


def test_fingerprints_of_extreme_ids(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [(low, "the least"), (high, "the largest"), (0, "zero"), (-1, "below zero"), (low + 1, "next to least")]
    rows += [(i * 7919 - 5000, f"text {i} " * (i % 9)) for i in range(90)]
    got = {r["doc_id"]: r["edited_sha256"] for r in merkle.with_next(frame(spark, rows)).collect()}
    down = sorted(rows, reverse=True)
    want = {i: sha(merkle.edited(t, down[(k + 1) % len(down)][1]).encode()) for k, (i, t) in enumerate(down)}
    assert got == want


def test_merkle_tree():
    rng = random.Random(2)
    paragraphs = [prose(rng, 60) for _ in range(12)]
    text = "\n".join(paragraphs)
    same, changed = merkle.fingerprint(text), merkle.fingerprint("\n".join([*paragraphs[:6], "new", *paragraphs[7:]]))
    assert merkle.likeness(same, merkle.fingerprint(text)) == 1.0
    assert 0.8 < merkle.likeness(same, changed) < 1
    only, other = merkle.differing(same, changed)
    assert 0 < len(only) < 40 and 0 < len(other) < 6
    assert merkle.likeness(same, merkle.fingerprint(prose(random.Random(9), 300))) < 0.2
    prints = {merkle.fingerprint(t) for t in ["", " ", "a", "a ", " a", "a\n", "\na", "a\n\n", "a b", "b a", "ab" * 500, "ab" * 501]}
    assert len(prints) == 12


def test_lm(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    rows = awkward()
    got = {}
    for r in lm.score(frame(spark, rows)).collect():
        got.setdefault((r["doc_id"], r["n_tokens"]), r)
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    uni, pairs, seen, kinds = Counter(), Counter(), Counter(), Counter()
    for i, t in rows:
        if not out[i]:
            w = [*tokens(t), None]
            uni.update(w)
            pairs.update(zip(["", *w[:-1]], w))
            seen.update(["", *w[:-1]])
    kinds.update(h for h, _ in pairs)
    n, v = sum(uni.values()), len(uni)
    for i, t in rows:
        w = [*tokens(t), None]
        base = [(uni[x] + 1) / (n + v + 1) for x in w]
        path = [
            max(pairs[h, x] - lm.DISCOUNT, 0) / seen[h] + lm.DISCOUNT * kinds[h] / seen[h] * p if seen[h] else p
            for h, x, p in zip(["", *w[:-1]], w, base)
        ]
        r = got[i, len(w)]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (out[i], sum(uni[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(map(math.log10, base)))
        assert r["score"] == pytest.approx(sum(map(math.log10, path)))
    # Each state's arcs sum to one over all known tokens and the unknown one.
    for h in list(seen)[:20]:
        total = sum(max(pairs[h, x] - lm.DISCOUNT, 0) / seen[h] for x in uni)
        assert total + lm.DISCOUNT * kinds[h] / seen[h] == pytest.approx(1)
    assert lm.score(frame(spark, [])).count() == 0


def test_packed_counts():
    n = np.array([0, 1, 254, 255, 256, 10**12, 3])
    assert lm.unpacked(lm.packed(n), len(n)).tolist() == n.tolist()


def toxic_rows(n: int):
    rng = random.Random(6)
    bad = ["grobling", "schnaffel", "mulkwort"]
    rows, marks = [], []
    for i in range(n):
        words = prose(rng, 80).split(" ")
        toxic = i % 3 == 0
        if toxic:
            for _ in range(4):
                word = rng.choice(bad)
                at = rng.randrange(2, len(word) - 1)
                words[rng.randrange(80)] = word[:at] + rng.choice("abcdefgh") + word[at + rng.randint(0, 1) :]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic), 1))
    return rows, marks


def test_toxicity(spark):
    rows, marks = toxic_rows(900)
    odd = [(2000, None), (2001, ""), (2002, " \n"), (None, "x"), (2003, "word " * 20000)]
    label_rows = spark.createDataFrame([*marks, (None, 1, 1), (2000, None, 1)], "doc_id long, toxic int, quality int")
    got = toxicity.held_out_scores(frame(spark, rows + odd), label_rows).collect()
    assert len(got) == len(rows) + len(odd)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 2000 and r["held_out"]]
    right = sum(r["predicted"] == (r["doc_id"] % 3 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    clean = toxicity.keep_clean(frame(spark, rows), toxicity.Model(np.zeros(toxicity.BUCKETS), np.zeros(toxicity.BUCKETS), 0.0, 1.0))
    assert clean.count() == len(rows) and clean.columns == frame(spark, rows).columns
    none = toxicity.held_out_scores(frame(spark, odd), label_rows.limit(0))
    assert {r["predicted"] for r in none.collect()} == {0}


def slow_toxicity(text: str | None, model) -> float:
    """The weighted mean written out: word by word, n-gram by n-gram."""
    counts, data = Counter(), lower(text).encode()
    for w in re.findall(rb"[a-z0-9@$*\x80-\xff]+", data):
        counts[w] += 1
    above, below = 0.0, model.rest
    for w, n in counts.items():
        of = next(iter(text_words(pa.array([w.decode()]), toxicity._INSIDE)))
        _, bucket = toxicity.subwords(of, np.array([0]))
        assert len(bucket) == 1 + sum(max(len(w) + 3 - k, 0) for k in toxicity.SIZES)
        weight = (1 + math.log(n)) * math.exp(np.clip(model.tells[bucket].mean(), -toxicity.STEEP, toxicity.STEEP))
        above, below = above + weight * model.values[bucket].mean(), below + weight
    return 1 / (1 + math.exp(-np.clip(above / below + model.bias, -30, 30)))


def test_toxicity_scores_against_brute_force():
    rng = np.random.default_rng(4)
    model = toxicity.Model(rng.normal(0, 9, toxicity.BUCKETS), rng.normal(0, 9, toxicity.BUCKETS), -0.4, 2.5)
    texts = [t for _, t in awkward()[:-1]] + ["a", "$@*", "été ÉTÉ idiot Idiot", "x" * 500]
    assert np.allclose(model.scores(pa.array(texts, pa.string())), [slow_toxicity(t, model) for t in texts])


def test_few_telling_words_in_long_texts():
    """Two misspelt words among a thousand decide, and a model of the plain mean would not see them."""
    rng = random.Random(3)
    bad = ["rotten", "vermin", "filthy", "wretch"]

    def text(n, mean):
        words = prose(rng, n).split()
        for _ in range(2 if mean else 0):
            words[rng.randrange(n)] = rng.choice(bad)
        return " ".join(words)

    marks = np.array([int(i % 4 == 0) for i in range(500)])
    model = toxicity.train(pa.array([text(rng.choice([20, 100, 400]), m) for m in marks]), marks)
    clean = model.scores(pa.array([text(1000, 0) for _ in range(60)]))
    mean = [text(1000, 1) for _ in range(60)]
    misspelt = [t.replace("rotten", "rottenn").replace("vermin", "veermin").replace("filthy", "filthyy").replace("wretch", "wretchh") for t in mean]
    assert (clean >= toxicity.THRESHOLD).sum() <= 1
    assert (model.scores(pa.array(mean)) >= toxicity.THRESHOLD).sum() >= 57
    assert np.median(model.scores(pa.array(misspelt))) > np.quantile(clean, 0.95)


REFERENCE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _holds(kind: str, match: str) -> bool:
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in match.split("."))
    if kind == "card":
        total = sum((2 * d - 9 if d > 4 else 2 * d) if i % 2 else d for i, d in enumerate(digits[::-1]))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 8 <= len(digits) <= 15


def brute_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    return {k: [m.span() for m in re.finditer(p, text) if _holds(k, m[0])] for k, p in REFERENCE.items()}


def test_one_line_of_very_many_addresses():
    """A line is looked at once, not once for every address in it."""
    import time

    def seconds(n):
        column = pa.array([" ".join(f"name{i % 50} user{i}@mail{i % 9}.org" for i in range(n))])
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), column], names=["key", "doc_id", "text"])
        begun = time.process_time()
        found = next(pii._found([batch]))
        assert found.column("n_email").to_pylist() == [n] and found.column("near").to_pylist()[0]
        return time.process_time() - begun

    seconds(1000)
    few, many = seconds(10_000), seconds(80_000)
    assert many < 20 * max(few, 0.05)


def test_pii_patterns():
    rng = random.Random(5)
    bits = ["a", "b@", "@", ".", "x.y", "1", "22", "255", "256", " ", "-", "+", "(", ")", "é", "1.2.3.4", "4111111111111111"]
    bits += ["4111 1111 1111 1111", "a@b.co", "+49 30 123456", "\n", "0000", "日"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        data = text.encode()
        points = pii._Points(data)
        got = {k: [(points[a], points[b]) for a, b in v] for k, v in pii.base_spans(data).items()}
        assert got == brute_spans(text)
    pii.base_spans(b"1" * 300_000 + b"@" * 300_000 + b"+" * 300_000)


def test_pii(spark):
    rows = awkward()
    secret = [(700 + i, f"{prose(random.Random(i), 12)}\nask Zorblatt é at z{'x' * 3}@corp.example {i} times\nend") for i in range(6)]
    rows += [*secret, (710, "Zorblatt alone"), (711, "call +49 30 1234567 or 10.0.0.1"), (711, "call +49 30 1234567 or 10.0.0.1")]
    df = frame(spark, rows)
    got = pii.spans(df).collect()
    assert len(got) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t or "")
    for r in got:
        fits = []
        for t in texts[r["doc_id"]]:
            want = brute_spans(t)
            base = ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k])
            if sha(base.encode()) == r["base_sha256"] and r["spans"].startswith(base):
                fits.append([r[f"n_{k}"] for k in pii.KINDS] == [len(want[k]) for k in pii.KINDS])
        assert any(fits)
    shown = {
        t[int(s.split(":")[1]) : int(s.split(":")[2])].lower()
        for r in got if r["spans"] for s in r["spans"].split(",") if s.startswith("term") for t in texts[r["doc_id"]][:1]
    }
    assert "zorblatt" in shown and "of" not in shown
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "@corp" not in clean[700] and "Zorblatt" not in clean[700] and "[EMAIL]" in clean[700]
    assert "Zorblatt" not in clean[710] and clean[711] == "call [PHONE] or [IP]" and clean[1] is None
    assert pii.sanitise(df).columns == df.columns
    assert pii.spans(frame(spark, [])).count() == 0


def test_pii_terms_on_few_lines(spark):
    rows = [(i, f"{prose(random.Random(i), 40)}\nsome words") for i in range(30)]
    rows += [(100, "write to Quixley at a.b@one.example"), (101, "Quixley again: a.b@one.example, some words")]
    # Two addresses of one domain, two numbers but for the last digits.
    rows += [(102, "Vornheim x@two.example"), (103, "y@two.example some Vornheim"), (104, "+1 (243) 555-5526 Ostrava"), (105, "Ostrava +1 (243) 555-9999")]
    # Copies of a line are one line; two domains have nothing in common; half of the lines have no address.
    rows += [(106, "Copied z@three.example"), (107, "Copied z@three.example"), (108, "Twofold u@four.example"), (109, "some Twofold v@five.example")]
    rows += [(110, "Halfway w@six.example"), (111, "some Halfway w@six.example"), (112, "Halfway"), (113, "some Halfway")]
    texts = dict(rows)
    shown = {
        texts[r["doc_id"]][int(s.split(":")[1]) : int(s.split(":")[2])].lower()
        for r in pii.spans(frame(spark, rows)).collect() for s in r["spans"].split(",") if s.startswith("term")
    }
    assert {"quixley", "vornheim", "ostrava"} <= shown
    assert shown.isdisjoint({"copied", "twofold", "halfway", "some", "words"})


def test_pii_classes():
    got = [pii.class_of(k, v) for k, v in (("email", b"a@B.example"), ("ip", b"10.00.7.9"), ("card", b"4111 1111-1111 1111"), ("phone", b"+1 (243) 555-5526"))]
    assert got == [b"b.example", b"10..7", b"411111", b"1243555"]


def naive_best_fit(lengths: list[int], room: int) -> list[int]:
    """What is left in each bin, one piece at a time."""
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(left) if r >= n]
        if fits:
            at = min(fits, key=lambda i: left[i])
            left[at] -= n
        else:
            left.append(room - n)
    return sorted(left)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(7)
    for _ in range(60):
        room = rng.choice([10, 64, 100])
        lengths = [min(room, 1 + int(rng.expovariate(3 / room))) for _ in range(rng.randint(1, 300))]
        runs = packing.plan(Counter(lengths), room)
        ends, seen, used = {}, [], Counter(lengths)
        for k, (length, rank, first, each, at) in enumerate(runs.tolist()):
            last = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == length else used[length]
            for i in range(last - rank):
                seen.append(length)
                place = first + i // each, at + i % each * length
                assert ends.get(place[0], 0) == place[1]
                ends[place[0]] = place[1] + length
        assert Counter(seen) == used
        assert sorted(room - e for e in ends.values()) == naive_best_fit(lengths, room)


def test_tightest():
    rng = random.Random(3)
    tree, open_ = packing.Tightest(50), set()
    for _ in range(3000):
        x = rng.randint(1, 50)
        tree.mark(x, x not in open_)
        open_ ^= {x}
        need = rng.randint(1, 50)
        assert tree.at_least(need) == min((c for c in open_ if c >= need), default=None)


def test_packing(spark):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(JSON)
    reference.encode_special_tokens = True
    rows = awkward() + [(500 + i, t) for i, t in enumerate(ODD)]
    got = packing.pack_documents(frame(spark, rows), JSON, PATTERN, added=False).collect()
    want = []
    for i, t in rows:
        ids = np.array([*reference.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert order(tuple(r)[:5] for r in got) == order(want)
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) == len(naive_best_fit([w[3] for w in want], 2048))
    assert packing.pack_documents(frame(spark, []), JSON, PATTERN).count() == 0


def test_added_tokens_as_the_library_finds_them(spark, tmp_path):
    from tokenizers import Tokenizer

    from rillstone.llm.queries import op10_best_fit_packing

    reference = Tokenizer.from_file(JSON)
    codec = bpe.Codec.of(JSON, PATTERN, added=True)
    assert codec.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    rng = random.Random(13)
    bits = [*WORDS, " ", "  ", "\n", "<|endoftext|>", "<|endoftext|", "<|", "'s", "\x1c"]
    texts = ["", "<|endoftext|>", "<|endoftext|>" * 2, "x" * 70000 + " <|endoftext|> y", *ODD]
    texts += ["".join(rng.choice(bits) for _ in range(30)) for _ in range(300)]
    for t in texts:
        assert codec.encode(t).tolist() == reference.encode(t, add_special_tokens=False).ids
    frame(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in op10_best_fit_packing(spark, str(tmp_path)).where("start = 0").collect()}
    for i, t in enumerate(texts):
        ids = np.array([*reference.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        if len(ids) <= 2048:
            assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_words_of_slices():
    from rillstone.llm.text import words

    texts = pa.array(["skip", None, "a B", "", "  c\td ", "é x"])
    got = [(w.first, w.docs, [int(x) for x in w.hashes], w.doc.tolist()) for w in words(texts.slice(1))]
    again = [(w.first, w.docs, [int(x) for x in w.hashes], w.doc.tolist()) for w in words(pa.array([None, "A b", "", "c d", "é x"]))]
    assert got == again and got[0][3] == [1, 1, 3, 3, 4, 4]
