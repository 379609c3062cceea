"""Operators on documents against brute force, and their corner cases."""

import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsloom.llm import line_dedup, minhash, mixing, packing, pii, toxicity
from newsloom.llm.queries import tokenizer_file
from tests.llm.helpers import WORD, Groups, prose, shingles, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    """Rows of (doc_id, text, source)."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows():
    """Nulls, empty and very long texts, repeated rows, one dominant source."""
    long = prose(30_000, 7)
    rows = [(i, prose(40 + i, i), "hot" if i % 3 else f"s{i % 4}") for i in range(1, 30)]
    return rows + [
        (30, None, "hot"), (31, "", None), (32, " \n\t ", "s1"), (33, "one two", "s1"),
        (34, long, "hot"), (35, long + " end", "hot"), (36, "ONE two", "s2"),
        (5, prose(45, 5), "hot"), (5, prose(45, 5), "hot"), (None, "no id at all here", "s1"),
    ]


# --- near duplicates ------------------------------------------------------------------


def near_rows():
    rows = []
    for base in range(6):
        own = words(120, 100 + base)
        rows.append((base * 100, " ".join(own), "s"))
        for copy in range(1, 8):
            changed = list(own)
            for k in range(copy - 1):
                changed[(17 * k + 5 * copy) % 120] = f"new{copy}x{k}"
            rows.append((base * 100 + copy, " ".join(changed), "s"))
    return rows


def test_near_duplicates_against_all_pairs(spark):
    rows = near_rows() + [r for r in odd_rows() if r[0] != 5 and r[0] is not None]
    rows = [(i + 1000 * (n >= len(near_rows())), t, s) for n, (i, t, s) in enumerate(rows)]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    sets = {i: shingles(t) for i, t, _ in rows}
    groups = Groups(sets)
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    for i in sets:
        assert tuple(got[i]) == (i, len(sets[i]), groups.top(i), groups.top(i) == i)


def test_near_duplicates_of_odd_rows(spark):
    got = minhash.near_duplicates(docs(spark, odd_rows()).withColumn("node", F.lit(1))).collect()
    assert len(got) == len(odd_rows())
    kept = {r.doc_id: r for r in got}
    assert kept[35].component_id == 34 and not kept[35].kept
    assert kept[36].component_id == 33  # same words in another case
    assert kept[30].n_shingles == kept[31].n_shingles == kept[32].n_shingles == 0
    assert kept[30].kept and kept[32].kept and kept[None].kept and kept[None].component_id is None
    assert [r.kept for r in got if r.doc_id == 5] == [True] * 3
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


# --- lines ----------------------------------------------------------------------------


def _normal(line):
    return re.sub(r"(?:[^\w]|_)+", " ", line.lower()).strip(" ")


def _edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_lines_against_all_pairs(spark):
    shared = [prose(60, 900 + k) for k in range(4)]
    rows = []
    for i in range(40):
        lines = [prose(12 + i % 5, i), shared[i % 4] if i % 2 else shared[i % 4].upper() + " !", "the end"]
        if i % 5 == 0:
            lines.append(shared[0].replace("sol", "sal", 1))
        if i % 7 == 0:
            lines.append(prose(300, 950) + (" tail" if i else ""))
        rows.append((i, "\n".join(lines), "s"))
    first, where = {}, {}
    for i, text, _ in rows:
        for pos, line in enumerate(text.split("\n")):
            line = _normal(line)
            if line:
                where[i, pos] = line
                first.setdefault(line, (i, pos))
    places = Groups(first.values())
    lines = list(first)
    for n, a in enumerate(lines):
        for b in lines[:n]:
            most = int(max(len(a), len(b)) * line_dedup.EDIT_SHARE)
            if abs(len(a) - len(b)) <= most and _edits(a, b) <= most:
                places.join(first[a], first[b])
    got = {r.doc_id: r for r in line_dedup.dedup(docs(spark, rows)).collect()}
    dropped = 0
    for i, text, _ in rows:
        kept = [
            line for pos, line in enumerate(text.split("\n"))
            if (i, pos) not in where or places.top(first[where[i, pos]]) == (i, pos)
        ]
        assert got[i].text == "\n".join(kept) and got[i].n_chars == len(got[i].text)
        dropped += got[i].n_dropped
    assert dropped > 30


def _changed(line, seed, whole):
    """A copy with as many edits as are allowed: of single letters all over, or of whole words."""
    rng = np.random.default_rng(seed)
    out = list(line)
    most = int(len(line) * line_dedup.EDIT_SHARE)
    if whole:
        parts, left = line.split(" "), most
        for k in rng.permutation(len(parts)):
            if len(parts[k]) <= left:
                left -= len(parts[k])
                parts[k] = "z" * len(parts[k])
        return " ".join(parts)
    for _ in range(most):
        k, how = int(rng.integers(len(out))), rng.random()
        if how < 0.5:
            out[k] = "z"
        elif how < 0.75:
            del out[k]
        else:
            out.insert(k, "z")
    return "".join(out)


def test_lines_within_the_share_are_found(spark):
    """Recall against edit distance alone, whatever the signatures, by words of the line."""
    pairs = []
    for count in (5, 6, 8, 10, 20, 36, 60, 100):
        for i in range(40):
            line = prose(count, 5000 + 100 * count + i)
            pairs.append((count, line, _normal(_changed(line, i, i % 2))))
    long = list(prose(1100, 77))
    for k in range(0, len(long), len(long) // 100):
        long[k] = "z" if long[k] != " " else " "
    pairs.append((1100, prose(1100, 77), "".join(long)))
    longer = F.greatest(F.length("one"), F.length("two"))
    alike = {
        r.k for r in spark.createDataFrame(
            [(k, one, two) for k, (_, one, two) in enumerate(pairs)], "k int, one string, two string"
        ).where((F.levenshtein("one", "two") <= F.floor(longer * line_dedup.EDIT_SHARE)) & (F.col("one") != F.col("two"))).collect()
    }
    assert len(pairs) - 1 in alike and len(alike) > 200
    rows = [(2 * k + n, lines[n], "s") for k, (_, *lines) in enumerate(pairs) for n in (0, 1)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup(docs(spark, rows)).collect()}
    for count in {count for count, _, _ in pairs}:
        own = [k for k in alike if pairs[k][0] == count]
        assert sum(got[2 * k + 1] for k in own) >= 0.9 * len(own), count


def test_no_join_of_lines_holds_all_blocks(spark, monkeypatch):
    """The disk a shuffle takes does not hold the bucket keys of all blocks at once."""
    blocks, made = [], line_dedup.buckets
    monkeypatch.setattr(line_dedup, "buckets", lambda signed, own: blocks.append(list(own)) or made(signed, own))
    rows = [(1, prose(30, 1), "s"), (2, prose(30, 1).replace("sol", "sal", 1), "s")]
    assert {r.n_dropped for r in line_dedup.dedup(docs(spark, rows)).collect()} == {0, 1}
    assert sorted(sum(blocks, [])) == list(range(line_dedup.BLOCKS))
    assert max(map(len, blocks)) <= line_dedup.BLOCKS // 5


def test_staging_leaves_no_shuffle_files(spark):
    from newsloom.llm.common import CLEANUP, stage

    folder = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before, setting = set(folder.rglob("shuffle_*.data")), spark.conf.get(CLEANUP)
    stage(spark.range(10_000).repartition(3, "id"), "shuffled")
    assert not set(folder.rglob("shuffle_*.data")) - before and spark.conf.get(CLEANUP) == setting


def test_short_lines_and_lines_without_blanks_repeat(spark):
    han = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(60))
    rows = [(1, f"Read more\n{han}", "s"), (2, f"read more!\n{han[:30]}\u4e00{han[31:]}", "s")]
    got = {r.doc_id: r for r in line_dedup.dedup(docs(spark, rows)).collect()}
    assert got[1].n_dropped == 0 and got[2].n_dropped == 2 and got[2].text == ""


def test_large_buckets_and_pairs_are_taken_in_bounded_parts(spark, monkeypatch):
    base = prose(60, 4).replace("\n", " ")
    rows = [(i, f"{base[:40 + i]}{'xyz'[i % 3]}{base[41 + i:]}\n{prose(20, 900 + i)}", "s") for i in range(14)]
    frame = docs(spark, rows)
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    whole = sorted(line_dedup.dedup(frame).collect())
    assert sum(r.n_dropped for r in whole) >= 10
    parts, grow = [], line_dedup.grow
    monkeypatch.setattr(line_dedup, "grow", lambda *a, **k: parts.append(a[0].count()) or grow(*a, **k))
    monkeypatch.setattr(line_dedup, "MEMBERS", 1)
    monkeypatch.setattr(line_dedup, "PAIRS", 30)
    assert sorted(line_dedup.dedup(frame).collect()) == whole
    assert len(parts) > 1


def test_word_count_rules_out_no_pair_within_the_share(spark):
    import random

    draw = random.Random(8)
    rows = []
    for i in range(600):
        line = "".join(draw.choice("ab  cd") for _ in range(draw.randrange(34, 150)))
        other = list(line)
        for _ in range(draw.randrange(2 + 2 * int(len(line) * line_dedup.EDIT_SHARE))):
            k, kind = draw.randrange(len(other)), draw.randrange(3)
            other[k : k + (kind != 1)] = [draw.choice(" ab")] * (kind != 2)
        rows.append((line, "".join(other)))
    longer = F.greatest(F.length("one"), F.length("two"))
    within = F.levenshtein("one", "two") <= F.floor(longer * line_dedup.EDIT_SHARE)
    got = spark.createDataFrame(rows, "one string, two string").select(
        within.alias("within"), line_dedup.edits("one", "two").alias("found")
    ).collect()
    assert {r.within for r in got} == {True, False}
    assert all(r.within == r.found for r in got)


def test_unrelated_lines_of_the_same_words_are_not_fetched(spark, monkeypatch):
    """Long lines of few different words have near signatures; their letters tell them apart."""
    import random

    draw = random.Random(3)
    few = [draw.choice("bdfgklmnprst") + draw.choice("aeiou") + draw.choice("lnrst") for _ in range(30)]
    rows = [(i, " ".join(draw.choice(few) for _ in range(130)), "s") for i in range(400)]
    rows.append((400, rows[0][1].replace(" ", " x", 1), "s"))
    asked, made = [], line_dedup.stage

    def counted(df, name, **options):
        table = made(df, name, **options)
        asked.extend([table.count()] if name == "pairs" else [])
        return table

    monkeypatch.setattr(line_dedup, "stage", counted)
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup(docs(spark, rows)).collect()}
    assert got[400] == 1 and sum(got.values()) == 1
    assert sum(asked) < 800


def _staged(monkeypatch, *names):
    """Rows of the tables that line_dedup stages under these names."""
    sizes, made = {name: [] for name in names}, line_dedup.stage

    def counted(df, name, **options):
        table = made(df, name, **options)
        if name in sizes:
            sizes[name].append(table.count())
        return table

    monkeypatch.setattr(line_dedup, "stage", counted)
    return sizes


def test_lines_of_the_same_words_in_another_order_are_not_compared(spark, monkeypatch):
    """Letters and words are the same, so only the signature can tell them apart."""
    import random

    draw = random.Random(11)
    own = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(120)]
    rows = [(i, " ".join(draw.sample(own, len(own))), "s") for i in range(60)]
    rows.append((60, rows[7][1].replace(own[5], "zzzzzz"), "s"))
    sizes = _staged(monkeypatch, "pairs")
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup(docs(spark, rows)).collect()}
    assert got[60] == 1 and sum(got.values()) == 1
    assert sum(sizes["pairs"]) < 100  # of 1,830


def test_a_pair_of_lines_is_met_in_one_block_and_compared_at_most_once(spark, monkeypatch):
    """Copies share many blocks; once they are one group no other pair of them is compared."""
    base = " ".join(word[:5] for word in words(40, 31))
    rows = [(i, f"{base[: 3 * i]}{'xyz'[i % 3]}{base[3 * i + 1 :]}", "s") for i in range(40)]
    assert all(130 < len(text) < 480 for _, text, _ in rows)  # of one way of voting
    sizes = _staged(monkeypatch, "near", "near-pairs", "pairs")
    got = line_dedup.dedup(docs(spark, rows)).collect()
    assert sum(r.n_dropped for r in got) == 39
    assert sum(sizes["near"]) == sizes["near-pairs"][0] > 200
    assert sum(sizes["pairs"]) < 80


def test_lines_within_the_share_meet_by_words_or_grams(spark):
    """Counted letters and ways of voting rule no pair out; long lines without blanks are found."""
    import random

    draw = random.Random(5)
    rows = []
    for i in range(300):
        line = "".join(draw.choice("eeettaax" + " " * (i % 4)) for _ in range(draw.randrange(100, 500))).strip()
        other = list(line)
        for _ in range(draw.randrange(1 + int(len(line) * line_dedup.EDIT_SHARE))):
            k, kind = draw.randrange(len(other)), draw.randrange(3)
            other[k : k + (kind != 1)] = [draw.choice(" eb")] * (kind != 2)
        rows.append((_normal(line), _normal("".join(other))))
    frame = spark.createDataFrame(rows, "one string, two string")
    differ = sum(
        (F.bit_count(a.bitwiseXOR(b)) for a, b in zip(line_dedup._bags(F.col("one")), line_dedup._bags(F.col("two")), strict=True)),
        F.lit(0),
    )
    common = F.arrays_overlap(line_dedup._families(F.col("one")), line_dedup._families(F.col("two")))
    got = frame.select(F.levenshtein("one", "two").alias("edits"), differ.alias("differ"), common.alias("common"), F.greatest(F.length("one"), F.length("two")).alias("n")).collect()
    assert all(r.differ <= 2 * r.edits for r in got)
    assert all(r.common for r in got if r.edits <= int(r.n * line_dedup.EDIT_SHARE))

    han = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(300))
    got = line_dedup.dedup(docs(spark, [(1, han, "s"), (2, f"{han[:150]}\u4e00{han[151:]}", "s")]))
    assert {r.doc_id: r.n_dropped for r in got.collect()} == {1: 0, 2: 1}


def test_lines_of_odd_rows(spark):
    frame = docs(spark, odd_rows()).withColumn("extra", F.lit("x")).withColumn("n", F.lit(0))
    got = line_dedup.dedup(frame)
    assert got.columns == [*frame.columns, "n_lines", "n_dropped"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[30].text is None and by_id[31].text == "" and by_id[33].text == "one two"
    assert by_id[34].n_dropped == 0 and by_id[35].n_dropped == 1 and by_id[35].text == ""
    # repeated rows are one document and come back alike
    assert {r.text for r in rows if r.doc_id == 5} == {prose(45, 5)}
    assert line_dedup.dedup(docs(spark, [])).count() == 0


# --- mixing ---------------------------------------------------------------------------


def _targets(sizes):
    """Targets by sharing again and again what is above the limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, rest = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in full]
        unit = rest / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * unit > 3 * sizes[s]]
        if not over:
            return full | {s: weight[s] * unit for s in free}
        for s in over:
            full[s] = 3.0 * sizes[s]
            rest -= full[s]


def test_mix_meets_its_targets(spark):
    rows = [(i, prose(20 + i % 60, i), ("a", "b", "c", "tiny", None)[min(i % 9, 4)]) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", "b"), (None, "with no id", "c")]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.taken == r.size * r.copies
        assert r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    wanted = _targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        # whole passes come before the draw
        assert r.size == 0 or r.copies in (int(r.target // r.source_size), int(r.target // r.source_size) + 1)
    for s in sizes:
        assert abs(taken[s] - wanted[s]) <= 20
    again = mixing.mix(docs(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_odd_rows(spark):
    got = mixing.mix(docs(spark, odd_rows()).withColumn("size", F.lit(-1)))
    assert got.count() == len(odd_rows()) and got.where("size < 0").isEmpty()
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None, None), (2, "", "a")])).agg(F.sum("taken")).first()[0] == 0


# --- packing --------------------------------------------------------------------------


def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer

    texts = {i: prose(5 + 37 * i % 900, i) + (", Ünï <|endoftext|>!\n" * (i % 3)) for i in range(120)}
    texts |= {200: None, 201: "", 202: prose(9000, 3), 203: "x" * 5000}
    rows = [(i, t, "s") for i, t in texts.items()]
    got = packing.pack(docs(spark, rows), tokenizer_file()).collect()
    whole = Tokenizer.from_file(tokenizer_file())
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    import zlib
    for i, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding <= 0.02 * sum(r.length for r in got)


def test_cutting_stock_covers_the_demand():
    rng = np.random.default_rng(5)
    for _ in range(20):
        demand = {int(n): int(c) for n, c in zip(rng.integers(1, 64, 12), rng.integers(1, 60, 12), strict=True)}
        found = packing.cutting_stock(demand, 64)
        made = dict.fromkeys(demand, 0)
        for pattern in found:
            assert sum(n * k for n, k in pattern.counts.items()) <= 64
            for n, k in pattern.counts.items():
                made[n] += k * pattern.copies
        assert made == demand
        bins = []  # first fit, longest first
        for n in sorted(demand, reverse=True):
            for _ in range(demand[n]):
                k = next((k for k, free in enumerate(bins) if free >= n), None)
                if k is None:
                    bins.append(64 - n)
                else:
                    bins[k] -= n
        assert sum(p.copies for p in found) <= len(bins) + 20
    assert packing.cutting_stock({}, 64) == []


def test_new_words_do_not_go_through_all_known_ones():
    import time

    encode = packing.Encoder(tokenizer_file())
    encode(["some words, to begin with"])
    encode.known.update((f"{k}", b"") for k in range(packing.CACHE - 1000))
    began = time.process_time()
    for k in range(200):
        encode([f"onemore{chr(97 + k % 26)}{chr(97 + k // 26)}, and more"])
    assert time.process_time() - began < 0.5


def test_new_words_are_encoded_together_and_without_marks():
    from tokenizers import Tokenizer

    whole, given = Tokenizer.from_file(tokenizer_file()), []

    class Spy:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    encode = packing.Encoder(tokenizer_file())
    encode.tokenizer = Spy()
    words = sorted({*prose(3000, 5).lower().split()})
    plain = " ".join(word.strip(".,;:!?") + mark for word in words for mark in ("", ".", ",", "!!"))
    odd = "don't, it's. 's x<|endoftext|>. e\u0301., \u00df\u00b5. 12a.b,c ..., \u0130. \u03a3\u03b1\u03c2. &&&"
    for text in (plain, odd, "", None, f"{odd} {plain}"):
        expected = np.array(whole.encode(text or "", add_special_tokens=False).ids, dtype="<u4")
        assert encode([text]) == [expected.tobytes()]
    assert len(given) <= len(words) / packing.TOGETHER + len(odd.split()) + 5


def test_packing_of_odd_rows(spark):
    got = packing.pack(docs(spark, odd_rows()), tokenizer_file())
    ends = got.where("start + length = doc_tokens").count()
    assert ends == len(odd_rows())
    assert packing.pack(docs(spark, []), tokenizer_file()).count() == 0


# --- personal data --------------------------------------------------------------------

TEXTS = {
    1: "Write to ana.b+c@mail.example.com, or a@b; call +49 (30) 901-82000 now.",
    2: "Hosts 10.0.0.255 and 300.1.1.1 and 1.2.3.4.5.6.7.8 and 007.1.1.1",
    3: "Cards 4111 1111 1111 1111, 4111111111111112 and 5500-0000-0000-0004.",
    4: None,
    5: "",
    6: "€uro ana@x@mail.example.org. +1 2 3",
    7: "ana" * 5000 + "@" + "x" * 5000 + " 1" * 5000,
}
STRICT = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _strict(text):
    found = []
    for kind, pattern in STRICT:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            fits = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def test_strict_spans(spark):
    import hashlib

    rows = [(i, t, "s") for i, t in TEXTS.items()]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    for i, text in TEXTS.items():
        own = _strict(text)
        counts = [sum(s.startswith(k) for s in own) for k, _ in STRICT]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == counts
        assert got[i].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert set(own) <= set(got[i].spans.split(",")) | {""}
    assert pii.redact(TEXTS[3], got[3].spans).count("[card]") == 2
    assert pii.find(docs(spark, [])).count() == 0


def test_generators_propose_disguised_data_and_spare_prose(spark):
    rows = []
    for i in range(300):
        rows.append((i, f"{prose(9, i)} mail u{i}.x@mail{i % 9}.example.com {prose(4, i)} token a{i}f{i}e", "s"))
        rows.append((1000 + i, f"{prose(5, i)} host 10.{i % 200}.3.{i % 90} ratio {i}/{i + 1} of {i * 7} {prose(4, i)}", "s"))
    # written as one of the addresses above, in disguise
    rows += [(5000, f"{prose(9, 3)} mail u3.x at mail3 dot example dot com {prose(4, 3)} token", "s"),
             (5001, prose(40, 4), "s")]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    assert got[5000].n_email == 0 and got[5001].spans == ""
    assert any(kind == 0 for kind, _, _ in pii.loose_spans(rows[-2][1]))
    assert all(got[i].n_email == 1 and "email:" in got[i].spans for i in range(300))


def test_the_trees_find_disguised_data(spark):
    rows = []
    for i in range(300):
        rows.append((i, f"{prose(9, i)} mail u{i}.x@mail{i % 9}.example.com {prose(4, i)} token a{i}f{i}e", "s"))
        rows.append((1000 + i, f"{prose(5, i)} host 10.{i % 200}.3.{i % 90} ratio {i}/{i + 1} of {i * 7} {prose(4, i)}", "s"))
    rows += [(5000, "mail u5.x at mail4.example dot com today", "s"), (5001, prose(40, 4), "s")]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    assert got[5000].n_email == 0 and got[5000].spans.startswith("email:")
    assert got[5001].spans == ""


def test_copies_do_not_fill_the_sample(spark):
    def vectors(kind, label, count):
        return [[float(kind), float(i), float(label)] + [0.0] * 17 for i in range(count)]

    rows = [(vectors(k, 1, 40), vectors(k, 0, 40)) for k in range(4)]
    rows += [(vectors(0, 1, 1) * 3000, vectors(0, 0, 1) * 3000)]
    frame = spark.createDataFrame(rows, "positive array<array<double>>, negative array<array<double>>")
    frame = frame.withColumn("proposed", F.transform("negative", lambda v: F.struct(v.alias("features"))))
    trees, limits = pii.train(frame, 320)
    assert sorted(limits) == [0, 1, 2, 3]


def test_the_trees_learn_from_all_rows(spark, monkeypatch):
    seen = []

    class Counted(pii.GBTClassifier):
        def fit(self, dataset, params=None):
            seen.append(dataset.agg(F.count("*"), F.sum("weight")).first())
            return super().fit(dataset, params)

    monkeypatch.setattr(pii, "GBTClassifier", Counted)

    def vectors(kind, label, count):
        return [[float(kind), float(i), float(label)] + [0.0] * 17 for i in range(count)]

    rows = [(vectors(k, 1, 40), vectors(k, 0, 60)) for k in range(4)] * 2
    frame = spark.createDataFrame(rows, "positive array<array<double>>, negative array<array<double>>")
    trees, limits = pii.train(frame, 8)
    assert [tuple(s) for s in seen] == [(4 * 75, 2 * 4 * 75.0)]  # every fourth is held out
    assert sorted(limits) == [0, 1, 2, 3]


def test_thresholds_are_the_lowest_scores_that_are_right_often_enough(spark):
    rows = [(0, 0.9, 1.0, 97.0), (0, 0.8, 1.0, 2.0), (0, 0.8, 0.0, 1.0), (0, 0.7, 1.0, 50.0),
            (0, 0.6, 0.0, 9.0), (1, 0.9, 0.0, 1.0), (2, 0.3, 1.0, 5.0)]
    scored = spark.createDataFrame(rows, "kind int, score double, label double, weight double")
    got = pii._thresholds(scored)
    assert got == {0: 0.7 - 1e-9, 2: 0.5}


# --- toxicity -------------------------------------------------------------------------


def test_toxicity_keeps_the_shares_of_the_table(spark, monkeypatch):
    rows, marks = [], []
    for i in range(300):
        bad = i % 5 == 0
        rows.append((i, prose(12, 31 * i) + (" grubnoddle vilksnout" if bad else ""), "s"))
        marks.append((i, int(bad)))
    frame, labels = docs(spark, rows), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    seen, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: seen.append(a) or fit(*a, **k))
    model = toxicity.train(frame, labels, 20, 20)
    marked = labels.where(~toxicity.held_out())
    bad = marked.where("toxic = 1").count()
    natural = bad / (marked.count() - bad)
    assert [len(texts) for texts in seen[0]] == [20, 20] and natural < 0.5
    assert abs(model.shift - fit(*seen[0]).shift - np.log(natural)) < 1e-9


def test_toxicity_learns_gapped_insults(spark):
    rows, marks = [], []
    insults = ("grubnoddle", "vilksnout", "patzwurm")
    for i in range(600):
        bad = i % 4 == 0
        text = ". ".join(prose(9, 31 * i + k) for k in range(4))
        if bad:
            text += f". {prose(2, i + 7)} {insults[i % 3]} {prose(3, i)}"
            text += f". {insults[(i + 1) % 3]}!" if i % 8 else ""
        rows.append((i, text, "s"))
        marks.append((i, int(bad)))
    rows += [
        (900, "You g r u b n o d d l e there", "s"), (901, "a vil.ks-no.ut and vilkxsnout", "s"),
        (902, None, "s"), (903, "", "s"), (None, prose(20, 9), "s"),
    ]
    table = docs(spark, rows)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.train(table, labels)
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    wrong = [i for i, bad in marks if got[i].predicted != bad]
    assert len(wrong) <= 6
    assert got[900].score > 0.5 > got[902].score == got[903].score and got[901].score > 0.5
    assert all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.train(table, labels.limit(0))
    assert none is None and toxicity.score(table, none).agg(F.max("score")).first()[0] == 0


def test_the_kernel_counts_weighted_subsequences():
    from itertools import combinations

    def plain(s, t):
        total = 0.0
        for a in combinations(range(len(s)), 3):
            for b in combinations(range(len(t)), 3):
                if [s[i] for i in a] == [t[j] for j in b]:
                    total += toxicity.DECAY ** (a[-1] - a[0] + b[-1] - b[0] + 2)
        return total

    pairs = [("clown", "clxown"), ("abc", "abc"), ("aabbc", "abcab"), ("abc", "xyz")]
    one, two = (toxicity._codes([p[k] for p in pairs], 8) for k in (0, 1))
    assert np.allclose(toxicity.kernel(one, two), [plain(*p) for p in pairs], rtol=1e-4)


def test_bridges_join_all_groups_that_touch():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**62, 60)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.9], rng.integers(0, 2**62, k)])) for k in rng.integers(0, 30, 80)]
    group = rng.integers(0, 6, 80)
    found = minhash.bridges(sets, group, 75)
    similar = {
        (i, j) for i in range(80) for j in range(80)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    }
    assert found and set(found) <= similar and all(group[i] != group[j] for i, j in found)
    asked, made = Groups(range(6)), Groups(range(6))
    for i, j in similar:
        asked.join(int(group[i]), int(group[j]))
    for i, j in found:
        made.join(int(group[i]), int(group[j]))
    assert [asked.top(x) for x in range(6)] == [made.top(x) for x in range(6)]
