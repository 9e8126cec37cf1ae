import itertools
import random
from collections import Counter, defaultdict

import numpy as np
from cases import SCHEMA, awkward, prose, table, words
from journeyline.llm import decontam, linededup, packing


def test_chunks_cover_the_lines_and_follow_them():
    import pyarrow as pa
    from journeyline.llm import textkit
    rng = random.Random(4)
    passage = "\n".join(prose(rng, 7) for _ in range(12))
    texts = ["", "a", "\n", "a\n\nb\n", passage, "x y\n" + passage + "\nz", None, prose(rng, 400)]
    pieces = defaultdict(list)
    for i, rows, data, offsets in textkit.pieces(pa.array(texts), 300):
        owner, nth, first, lines, s, e, h, worded = linededup.chunks(data, offsets)
        for k in range(len(owner)):
            pieces[i + owner[k]].append((nth[k], first[k], lines[k], bytes(data[s[k]:e[k]]).decode(), worded[k]))
    for r, text in enumerate(texts):
        mine = pieces[r]
        assert "\n".join(p[3] for p in mine) == (text or "")
        assert [p[0] for p in mine] == list(range(len(mine)))
        assert sum(p[2] for p in mine) == (text or "").count("\n") + 1
        assert all(p[3].count("\n") + 1 == p[2] and p[4] == bool(words(p[3])) for p in mine)
    inner = {p[3] for p in pieces[4]}
    assert len(inner & {p[3] for p in pieces[5]}) >= len(inner) - 2  # boundaries shift with the passage


def test_repeated_chunks_equal_brute_force(spark):
    rng = random.Random(8)
    passage = "\n".join(prose(rng, 6).replace("\n", " ") for _ in range(15))
    rows = awkward() + [(6000 + i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30), None, None, 0, "", 0, 0, "") for i in range(30)]
    import pyarrow as pa
    from journeyline.llm import textkit
    texts = [r[1] for r in rows]
    places, spans = defaultdict(list), {}
    for i, n, data, offsets in textkit.pieces(pa.array(texts)):
        owner, nth, first, lines, s, e, h, worded = linededup.chunks(data, offsets)
        for k in range(len(owner)):
            if lines[k] > 1 and worded[k] and rows[i + owner[k]][0] is not None:
                place = (rows[i + owner[k]][0], int(nth[k]))
                places[bytes(data[s[k]:e[k]])].append(place)
                spans[(i + owner[k], int(nth[k]))] = (int(first[k]), int(lines[k]))
    gone = {p for many in places.values() for p in many if p != min(many)}
    assert gone
    got = linededup.line_dedup(table(spark, rows)).collect()
    want = Counter()
    for i, (doc_id, text) in enumerate((r[0], r[1]) for r in rows):
        drop = {x for (row, nth), (first, n) in spans.items() if row == i and (doc_id, nth) in gone for x in range(first, first + n)}
        want[(doc_id, None if text is None else "\n".join(x for j, x in enumerate(text.split("\n")) if j not in drop), len(drop))] += 1
    assert want == Counter((r.doc_id, r.clean_text, r.n_removed_lines) for r in got)
    out = linededup.remove_repeated(table(spark, rows))
    assert out.columns == table(spark, rows).columns and Counter((r.doc_id, r.text) for r in out.collect()) == Counter((k[0], k[1]) for k in want.elements())
    assert linededup.line_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_leaks(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, 30 + i).replace("\n", " ")) for i in range(8)] + [(50, None), (51, ""), (52, "too short to tell"), (None, prose(rng, 20))]
    rows, want = awkward(), set()
    for k, (item, text) in enumerate(items[:8]):
        w = text.split()
        for j in range(0, len(w), 9):
            w[j] = "other"  # a substitution in each nine words
        spots = (" ".join(w), text.upper(), " ".join(text.split()[:18]))
        for n, s in enumerate(spots):
            rows.append((7000 + 10 * k + n, f"{prose(rng, 50)} {s}\n{prose(rng, 40)}", None, None, 0, "", 0, 0, ""))
            want.add((7000 + 10 * k + n, item))
        rows.append((7005 + 10 * k, f"{prose(rng, 50)} {' '.join(text.split()[:7])} {prose(rng, 40)}", None, None, 0, "", 0, 0, ""))
    rows += [rows[-2]] * 2
    bench = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, key0 string")
    df = table(spark, rows)
    found = decontam.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want) + 2
    left = decontam.remove_contaminated(df, bench)
    assert left.columns == df.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r[0] for r in rows if r[0] not in {d for d, _ in want})
    assert decontam.contaminated(spark.createDataFrame([], SCHEMA), bench).count() == 0
    assert decontam.remove_contaminated(df, bench.limit(0)).count() == len(rows)
    limit, decontam.BROADCAST_SEEDS = decontam.BROADCAST_SEEDS, 0  # the way for a large benchmark
    try:
        assert {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()} == want
    finally:
        decontam.BROADCAST_SEEDS = limit


def test_a_mask_is_left_wherever_three_of_thirteen_words_differ():
    n, k = decontam.WINDOW, decontam.WINDOW - decontam.MATCHED
    for differ in itertools.combinations(range(n), k):
        assert any(not {o + p for p in mask} & set(differ) for mask in decontam.MASKS for o in range(n - mask[-1]))


def all_leaks(rows, items):
    """{(doc_id, item_id): best (matched, -item_start)} by comparing every window of every item with every place of every text."""
    found = {}
    for doc_id, text in ((r[0], r[1]) for r in rows):
        own = words((text or "").lower())
        at = defaultdict(list)
        for i, w in enumerate(own):
            at[w].append(i)
        for item_id, item in items:
            theirs = words((item or "").lower())
            if not theirs or len(theirs) <= decontam.WHOLE_TEXT:
                if theirs and own == theirs:
                    found[doc_id, item_id] = (len(theirs), 0)
                continue
            width = min(len(theirs), decontam.WINDOW)
            agree = defaultdict(set)
            for j, w in enumerate(theirs):
                for i in at[w]:
                    agree[i - j].add(j)
            best = max(((sum(j in js for j in range(s, s + width)), -s) for js in agree.values() if len(js) >= min(len(theirs), decontam.MATCHED)
                        for s in range(len(theirs) - width + 1)), default=(0, 0))
            if best[0] >= min(len(theirs), decontam.MATCHED):
                found[doc_id, item_id] = best
    return found


def test_leaks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 16)  # passages cross blocks
    rng = random.Random(77)
    flat = lambda n: prose(rng, n).replace("\n", " ")
    items = [(i, flat(13 + i % 9)) for i in range(20)] + [(100 + n, flat(n)) for n in range(1, 13)] + [(200, None), (201, " "), (202, flat(13).upper())]
    rows, k = [(0, None), (1, ""), (2, "one two")], 10
    for item_id, item in items:
        w = (item or "").split()
        for subs in (0, 1, 2, 3, 3, 3, 4):
            at = rng.randrange(max(1, len(w) - 12))
            passage = w[at:at + 13]
            for j in rng.sample(range(len(passage)), min(subs, len(passage))):
                passage[j] = f"s{rng.randrange(99)}"
            for before, after in ((0, 0), (25, 30), (0, 9), (9, 0)):
                rows.append((k, " ".join([flat(before), *passage, flat(after)])))
                k += 1
        rows.append((k, " ".join(w[3:13])))  # the window begins before the text
        k += 1
    rows += [(k, "same " * 60), (k + 1, f"{flat(5000)} {items[3][1]} {flat(5000)}")]
    items.append((300, "same " * 14))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = all_leaks(rows, items)
    got = decontam.contaminated(df, bench).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {(r.doc_id, r.item_id): (r.matched, -r.item_start) for r in got} == want
    assert sum(1 for _, i in want if i < 100) > 400 and {i for _, i in want} >= set(range(106, 113))


def naive_best_fit(sizes, width):
    rows = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        fits = [r for r in rows if r[0] >= sizes[k]]
        if fits:
            r = min(fits, key=lambda r: r[0])
        else:
            rows.append(r := [width, []])
        r[0] -= sizes[k]
        r[1].append(k)
    return Counter(r[0] for r in rows)


def test_segment_tree_finds_the_best_fit():
    rng = random.Random(1)
    for width in (1, 7, 64, 100, 2048):
        for _ in range(20):
            sizes = [rng.randint(1, width) for _ in range(rng.randint(0, 200))]
            got = packing.best_fit(sizes, width)
            assert sorted(k for r in got for k in r) == list(range(len(sizes)))
            assert Counter(width - sum(sizes[k] for k in r) for r in got) == naive_best_fit(sizes, width)


def test_packed_rows_decode_to_the_texts(spark):
    rows = awkward()
    with open(packing.RANKS, "rb") as f:
        enc = packing.encoder(f.read())
    out = packing.pack(table(spark, rows), width=256).collect()
    parts = defaultdict(list)
    for r in out:
        ids, positions = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256
        assert (ids[r.n_tokens:] == packing.PAD).all()
        for k, (doc, part) in enumerate(zip(r.doc_ids, r.parts)):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert positions[a:b].tolist() == list(range(b - a))
            parts[doc].append((part, ids[a:b].tolist()))
    by = defaultdict(list)
    for r in rows:
        if r[1]:
            by[r[0]].append(r[1])
    assert set(parts) == set(by)
    for doc, texts in by.items():
        if len(texts) == 1:
            assert enc.decode([x for _, ids in sorted(parts[doc]) for x in ids]) == texts[0]
            assert [p for p, _ in sorted(parts[doc])] == list(range(len(parts[doc])))
        else:
            assert sum(len(ids) for _, ids in parts[doc]) == sum(len(enc.encode_ordinary(t)) for t in texts)
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_that_share_a_doc_id_are_told_apart(spark):
    rng = random.Random(3)
    rows = [(7, prose(rng, 900)), (7, prose(rng, 700)), (None, prose(rng, 800)), (None, prose(rng, 30)), (8, "a b"), (8, "a b")]
    with open(packing.RANKS, "rb") as f:
        enc = packing.encoder(f.read())
    parts = defaultdict(list)
    for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), width=128).collect():
        ids = np.frombuffer(r.input_ids, "<u2")
        for k, key in enumerate(zip(r.doc_ids, r.doc_keys)):
            parts[key].append((r.parts[k], ids[r.cu_seqlens[k]:r.cu_seqlens[k + 1]].tolist()))
    got = Counter((doc_id, enc.decode([x for _, ids in sorted(many) for x in ids])) for (doc_id, _), many in parts.items())
    assert got == Counter({**{row: 1 for row in rows[:4]}, (8, "a ba b"): 1})  # equal rows share a key


def test_groups_are_sized_by_parts_and_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PARTS", 40)
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.choice([5, 40, 3000]))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    outs = [packing.pack(df.repartition(n), width=64).collect() for n in (1, 4)]
    assert sorted(map(str, outs[0])) == sorted(map(str, outs[1]))
    sizes = Counter()
    for r in outs[0]:
        sizes[r.pack_group] += len(r.parts)
    assert len(sizes) > 60 * 3000 / 64 / 40 / 2 and max(sizes.values()) < 4 * 40


def test_copies_of_one_row_are_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PARTS", 40)
    monkeypatch.setattr(packing, "HEAVY", 20)
    df = spark.createDataFrame([(None, "one text that comes often")] * 600 + [(i, f"text {i}") for i in range(600)], "doc_id long, text string")
    for limit in (packing.BROADCAST_KEYS, 0):
        monkeypatch.setattr(packing, "BROADCAST_KEYS", limit)
        sizes, copies = Counter(), 0
        for r in packing.pack(df, width=64).collect():
            sizes[r.pack_group] += len(r.parts)
            copies += r.doc_ids.count(None)
        assert copies == 600 and sum(sizes.values()) == 1200 and max(sizes.values()) < 3 * 40


def earlier_runs(rows, least=50, least_lines=None):
    """Lines of runs of ``least`` words, or of ``least_lines`` lines, that stand at an earlier place, by comparing all pairs of equal lines; no chunks, no hashes."""
    docs = sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None})
    at, gone = defaultdict(list), defaultdict(set)
    split = [t.split("\n") for _, t in docs]
    for d, lines in enumerate(split):
        for i, line in enumerate(lines):
            for e, j in at[line] if words(line) else ():
                n = 0
                while i + n < len(lines) and j + n < len(split[e]) and lines[i + n] == split[e][j + n]:
                    n += 1
                if sum(len(words(x)) for x in lines[i:i + n]) >= least or least_lines and n >= least_lines:
                    gone[docs[d]].update(k for k in range(i, i + n) if words(lines[k]))
            at[line].append((d, i))
    return gone


def test_every_repeated_run_goes_and_its_first_place_stays(spark):
    rng = random.Random(21)
    line = lambda n: prose(rng, n).replace("\n", " ")
    rows = awkward()
    for k, passage in enumerate(([line(50)], [line(30), line(25)], [line(20), "", line(20), line(20)], [line(12) for _ in range(5)], [line(9) for _ in range(14)])):
        for i in range(4):
            rows.append((8000 + 10 * k + i, "\n".join([line(8), line(70), *passage, line(6), line(60)]), None, None, 0, "", 0, 0, ""))
    short = line(49)
    rows += [(8100 + i, f"{line(5)}\n{short}\n{line(5)}", None, None, 0, "", 0, 0, "") for i in range(3)]
    loop = line(30)
    rows.append((8200, "\n".join([loop] * 5), None, None, 0, "", 0, 0, ""))
    want, most = earlier_runs(rows), earlier_runs(rows, least_lines=2)
    assert all(len([x for x in want[r[0], r[1]]]) for r in rows if 8000 <= (r[0] or 0) < 8050 and r[0] % 10)
    got = linededup.passage_dedup(table(spark, rows)).collect()
    texts = defaultdict(list)
    for r in got:
        texts[r.doc_id].append(r)
    left = Counter(x for r in got if r.clean_text is not None for x in set(r.clean_text.split("\n")))
    for doc_id, text in {(r[0], r[1]) for r in rows}:
        lines = None if text is None else text.split("\n")
        gone = None
        for r in texts[doc_id]:
            mine = {x for s in r.spans or () for x in range(s.first_line, s.first_line + s.n_lines)}
            assert len(mine) == r.n_removed_lines == sum(s.n_lines for s in r.spans or ())
            if lines is not None and r.clean_text == "\n".join(x for k, x in enumerate(lines) if k not in mine) and len(lines) == r.n_lines:
                gone = mine
        if lines is None or doc_id is None:
            assert all(not r.n_removed_lines for r in texts[doc_id])
        else:
            assert gone is not None and want[doc_id, text] <= gone
            assert {k for k in gone if words(lines[k])} <= most[doc_id, text]  # nothing goes that has no earlier place
            assert all(left[lines[k]] for k in gone)  # each line that went stands somewhere
    assert all(not r.n_removed_lines for r in got if r.doc_id is not None and 8100 <= r.doc_id < 8103)
    out = linededup.remove_passages(table(spark, rows))
    assert out.columns == table(spark, rows).columns and Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r.doc_id, r.clean_text) for r in got)
    assert linededup.passage_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
