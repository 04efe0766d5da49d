"""Lines, passages, near copies."""

import hashlib
import random

import numpy as np
import pytest

from mobspark.llm import common, lines, simhash, suffixes


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rnd, text, n, letters="abcd"):
    b = list(text)
    for _ in range(n if b else 0):
        i = rnd.randrange(len(b))
        kind = rnd.randrange(3)
        if kind == 0:
            b[i] = rnd.choice(letters)
        elif kind == 1:
            b.insert(i, rnd.choice(letters))
        else:
            del b[i]
    return "".join(b)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_banded_distance_and_meetings(most):
    rnd = random.Random(most)
    pairs = []
    for _ in range(600):
        a = "".join(rnd.choice("abc\x00é") for _ in range(rnd.randrange(2 * most + 2, 30)))
        pair = sorted((a, edited(rnd, a, rnd.randrange(5))), key=len)
        if len(pair[1]) - len(pair[0]) <= most < len(pair[0]):
            pairs.append(tuple(pair))
    for (a, b), d in zip(pairs, lines.verified(pairs, most).tolist(), strict=True):
        want = edit_distance(a, b)
        assert d == min(want, most + 1)
        if 0 < want <= most:
            assert lines.first_meeting(a, b, most) in set(lines.segment_keys(a, most)) & set(lines.segment_keys(b, most))


def test_distances_of_pairs_with_few_and_with_many_different_characters():
    rnd = random.Random(9)
    few = [(a, edited(rnd, a, k)) for k in range(9) for a in ["".join(rnd.choice("abcdefgh") for _ in range(60))]]
    many = [(a, edited(rnd, a, k, "\U0001f600z")) for k in range(9) for a in ["".join(chr(300 + rnd.randrange(900)) for _ in range(400))]]
    for pairs in (few, many, few + many):
        pairs = [tuple(sorted(p, key=len)) for p in pairs]
        assert lines.verified(pairs, 9).tolist() == [min(edit_distance(a, b), 10) for a, b in pairs]


def brute_lines(docs, min_chars, edits):
    """docs: (doc_id, text) in order; kept text, removed and links of each."""
    first, near, n_links = {}, {}, {}
    for d, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if len(x) >= min_chars:
                first.setdefault(x, (d, k))
    distinct = list(first)
    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            if abs(len(x) - len(y)) <= edits and edit_distance(x, y) <= edits:
                for a, b in ((x, y), (y, x)):
                    near[a] = min(near.get(a, first[b]), first[b])
                    n_links[a] = n_links.get(a, 0) + 1
    out = {}
    for d, t in docs:
        own = (t or "").split("\n")
        goes = [len(x) >= min_chars and min(first[x], near.get(x, first[x])) != (d, k) for k, x in enumerate(own)]
        kept = None if t is None else "\n".join(x for x, g in zip(own, goes, strict=True) if not g)
        out[d] = (kept, sum(goes), sum(n_links.get(x, 0) for x in own if len(x) >= min_chars))
    return out


@pytest.mark.parametrize("block", [2000, 5])
def test_line_dedup_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(20, 40))) for _ in range(12)] + ["short", "", "same start of the line " + "x" * 12]
    docs = []
    for i in range(60):
        docs.append((i, "\n".join(edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2, 4])) if rnd.random() < 0.8 else "" for _ in range(rnd.randrange(6)))))
    docs += [(100, None), (101, ""), (102, "y" * 30_000), (103, "y" * 29_999 + "z"), (104, "日本語" * 10), (105, "日本語" * 10 + "x")]
    df = spark.createDataFrame([(*d, "a", 5) for d in docs], "doc_id long, text string, removed string, text_hash int").repartition(3)
    small = [d for d in docs if d[0] < 100 or d[0] > 103]
    got = {r.doc_id: r for r in lines.deduplicate_lines(df).collect()}
    want = brute_lines([d for d in small], lines.MIN_CHARS, lines.MAX_EDITS)
    for d, (kept, removed, n_links) in want.items():
        assert (got[d].text, got[d].n_removed, got[d].n_links) == (kept, removed, n_links), d
    assert got[100].text is None and got[101].text == "" and got[102].n_removed == 0 and got[103].n_removed == 1 and got[103].earlier == [102]
    kept = lines.without_repeated_lines(df)
    assert kept.columns == df.columns and {100, 101, 102} <= {r.doc_id for r in kept.collect()} and 103 not in {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("block", [2000, 5])
def test_limit_of_line_dedup_grows_with_length(spark, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    rnd = random.Random(3)
    sizes = [93, 94, 95, 96, 97, 98, 127, 128, 129, 200, 333, 480, 1000, 1030]
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in sizes] + ["ab" * 60, "x" * 150]
    made = [edited(rnd, x, n) for x in base for n in (0, 0, 2, 3, 4, 6, 10, 15, 31, 33)] + ["x" * 149 + "y"]
    rnd.shuffle(made)
    docs = [(i, "\n".join(made[i * 3:i * 3 + 3])) for i in range((len(made) + 2) // 3)]
    distinct = sorted(set(made))
    n_links, near = dict.fromkeys(distinct, 0), {}
    for i, x in enumerate(distinct):
        for y in distinct[i + 1:]:
            most = max(2, min(min(len(x), len(y)) // 32, 31))
            if abs(len(x) - len(y)) <= most:
                near.setdefault(most, []).append(tuple(sorted((x, y), key=len)))
    for most, pairs in near.items():
        for pair, d in zip(pairs, lines.verified(pairs, most).tolist(), strict=True):
            for x in pair if d <= most else ():
                n_links[x] += 1
    assert sum(n_links.values()) > 150
    got = {r.doc_id: r.n_links for r in lines.deduplicate_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert got == {d: sum(n_links[x] for x in t.split("\n")) for d, t in docs}
    changed = base[9][:80] + "zzzzz" + base[9][85:]
    pair = spark.createDataFrame([(1, base[9]), (2, changed)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.deduplicate_lines(pair).collect()} == {1: 0, 2: 1}


def test_line_dedup_of_null_and_repeated_ids_and_no_rows(spark):
    long = "a line that is long enough to be linked"
    df = spark.createDataFrame([(None, long), (1, long + "s"), (1, long + "s"), (2, "other\n" + long)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text, r.n_removed) for r in lines.deduplicate_lines(df).collect()), key=str)
    assert got == [(0, long, 0), (1, "", 1), (1, "", 1), (2, "other", 1)]
    assert lines.deduplicate_lines(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2000, 20])
def test_groups_of_near_lines_give_a_row_for_each_line(spark, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcdefgh ") for _ in range(size)) for size in (100, 100, 30)]
    near = sorted({edited(rnd, base[k], rnd.randrange(4), "abcdefgh") for k, n in ((0, 45), (1, 12), (2, 40)) for _ in range(n)})
    rnd.shuffle(near)
    df = spark.createDataFrame([(i // 3, x, i) for i, x in enumerate(near)], "doc_id long, text string, text_hash long").repartition(3)
    found = {(r.h1, r.h2): (r.n_links, tuple(r.nearest)) for r in lines.links(df).collect()}
    want = {}
    for i, a in enumerate(near):
        linked = [k for k, b in enumerate(near) if k != i and abs(len(a) - len(b)) <= 3
                  and edit_distance(a, b) <= lines.limit(min(len(a), len(b)), lines.MAX_EDITS)]
        if linked:
            h1, h2 = lines.halves([lines.line_digest(a)])[0].tolist()
            want[h1, h2] = len(linked), (min(linked) // 3, min(linked), 0)
    assert len(want) > 60 and found == want


def test_lines_that_share_a_string_only_are_told_apart_before_their_texts_travel(spark):
    rnd = random.Random(11)
    shared = "a passage that many of the lines hold"
    made = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size)) + shared for size in [300] * 20 + [3000, 9000]]
    near = [made[0], edited(rnd, made[0], 9), made[-1], edited(rnd, made[-1], 31)]
    profiles = lines.line_profiles(near)
    assert lines.may_link(profiles[::2], profiles[1::2], 2).all()
    assert not lines.may_link(*lines.line_profiles(made[-2:]).reshape(2, 1), 2).any()
    df = spark.createDataFrame([(i, x, i) for i, x in enumerate(made)], "doc_id long, text string, text_hash long")
    met = lines.meetings(lines.segments(df, lines.MIN_CHARS, 2), 2).distinct().collect()
    assert len([r for r in met if r.own == lines.PAIR]) <= 2 and not lines.links(df).count()


def test_index_travels_packed_and_only_rows_that_meet_get_a_profile(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9)))
    made = [" ".join(word() for _ in range(rng.choice((5, 12, 60)))) for _ in range(150)]
    made += [made[k][:30] + "\u20ac" + made[k][30:] for k in range(0, 60, 3)] + made[:20]
    made = [x for x in made if len(x) >= lines.MIN_CHARS]
    docs = [(i, "\n".join(made[i::7]), i) for i in range(7)]
    df = spark.createDataFrame(docs, "doc_id long, text string, text_hash long").repartition(3)
    rows, profiles, border = set(), {}, lines.long_from(2)
    for line in set(made):
        h1 = int(lines.halves([lines.line_digest(line)])[0, 0])
        profiles[h1] = int(lines.line_profiles([line])[0])
        if len(line) < border + 2:
            cuts = zip(lines.segment_keys(line, 2), lines.look_ups(len(line), 2), strict=True)
            rows |= {(int.from_bytes(key, "big", signed=True), h1, own) for key, (_, _, seed, own) in cuts if seed < border * 3}
        if len(line) >= border:
            rows |= {(int(np.uint64(key).view(np.int64)), h1, own) for key, own in lines.gram_rows([line], 2)[0].items()}
    by_key: dict[int, set] = {}
    for key, h1, own in rows:
        by_key.setdefault(key, set()).add((h1, own))
    meet = {key for key, of in by_key.items() if len({h1 for h1, _ in of}) > 1 and any(own for _, own in of)}
    want = {(key, h1, own * lines.OWN + profiles[h1]) for key, h1, own in rows if key in meet}
    assert 0 < len(want) < len(rows) / 2
    index = lines.segments(df, lines.MIN_CHARS, 2)
    assert {tuple(r) for r in index.collect()} == want
    common.drop_written(index)
    monkeypatch.setattr(lines, "CHUNK", 1000)
    monkeypatch.setattr(lines, "PACKED_ROWS", 100)
    for bits in (1, 5):
        got = lines.packed_segments(df, lines.MIN_CHARS, 2, bits).collect()
        parts = [(r, lines.unpacked(r["rows"], r["packed"])) for r in got]
        lower, upper = ([x for r, x in parts if (r["bucket"] >> bits) == k] for k in (0, 1))
        back = lambda keys: (keys * lines.GATHER).view(np.int64).tolist()
        assert {x for key, h1, own in lower for x in zip(back(key), h1.tolist(), own.tolist(), strict=True)} == rows
        assert dict(x for h1, told, _ in upper for x in zip(back(h1), told.tolist(), strict=True)) == profiles
        assert sum(len(r["packed"]) for r in got) <= sum(16 * r["rows"] + r["rows"] // 8 + 1 for r in got)


@pytest.mark.parametrize("rounds", [16, 1, 1000])
def test_strings_that_lines_take(monkeypatch, rounds):
    monkeypatch.setattr(lines, "ROUNDS", rounds)
    rnd = random.Random(rounds)
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.choice([96, 97, 130, 400, 1100]))) for letters in ["ab", "abcdefgh é", "x\U0001f600"] for _ in range(25)]
    texts += ["y" * 2000, "ab" * 60, "abc" * 40 + "z" * 40]
    for text, rows in zip(texts, lines.gram_rows(texts, 2), strict=True):
        at = {}
        for p in range(len(text) - lines.GRAM + 1):
            at.setdefault(text[p:p + lines.GRAM], []).append(p)
        hashes = {g: h for g, h in zip(at, (int(lines.gram_hashes(np.array([*map(ord, g)], np.uint32))[0]) for g in at), strict=True)}
        want, starts = {}, []
        for g in sorted(at, key=hashes.get):
            if len(starts) > lines.limit(len(text), 2):
                break
            free = [p for p in at[g] if all(abs(p - q) >= lines.GRAM for q in starts)]
            while free:
                starts.append(free[0])
                want[hashes[g]] = True
                free = [p for p in free if p - starts[-1] >= lines.GRAM]
            want.setdefault(hashes[g], False)
        else:
            want = want if len(starts) > lines.limit(len(text), 2) else dict.fromkeys(hashes.values(), True)
        assert rows == want and lines.gram_rows([text], 2) == [want]


def test_short_lines_go_if_equal_ones_stand_earlier(spark, tmp_path):
    docs = [(1, "Home\n\n x"), (2, "Home\nHone\n\n  "), (3, " x\nHome"), (4, "a line of its own that is long enough\nHone")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_links, r.earlier) for r in lines.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 0, []), 2: (1, 0, [1]), 3: (2, 0, [1]), 4: (1, 0, [2])}
    kept = {r.doc_id: r.text for r in lines.without_repeated_lines(df).collect()}
    assert kept == {1: "Home\n\n x", 2: "Hone\n\n  ", 4: "a line of its own that is long enough"}


def test_cover_and_ranks():
    for period in (7, 32, 64):
        cover = suffixes.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
        steps = suffixes.common_steps(cover, period)
        for i in range(period):
            for j in range(period):
                assert (i + steps[i, j]) % period in cover and (j + steps[i, j]) % period in cover
    data = np.array([ord(random.Random(1).choice("ab")) for _ in range(50)] * 20 + [0] * 400, np.uint8)
    rank = suffixes.sample_ranks(data, suffixes._COVER, 100)
    places = np.flatnonzero(rank[:1000] >= 0)
    text = data.tobytes()
    order = sorted(places, key=lambda p: text[p:p + 128])
    assert all(rank[a] <= rank[b] for a, b in zip(order, order[1:], strict=False))


def brute_passages(docs, length=100):
    seen, out = set(), []
    for d, t in docs:
        b = (t or "").encode()
        spans = []
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
            else:
                seen.add(b[p:p + length])
        kept, at = [], 0
        for x, y in spans:
            kept.append(b[at:x])
            at = y
        out.append((d, len(b), sum(y - x for x, y in spans), len(spans), hashlib.sha256(b"".join([*kept, b[at:]])).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "chunk", "block"), [(5000, 1 << 20, 3 << 20), (3, 700, 4000)])
def test_passages_against_all_strings(spark, monkeypatch, hot, chunk, block):
    for name, value in (("HOT_RUNS", hot), ("CHUNK", chunk), ("BLOCK", block)):
        monkeypatch.setattr(suffixes, name, value)
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rnd.randrange(15, 80))) for _ in range(6)]
    docs = [(i, " ".join(x for _ in range(rnd.randrange(4)) for x in (word(), rnd.choice(passages)[rnd.randrange(9):], word()))) for i in range(60)]
    docs += [(70, None), (71, ""), (72, "z" * 5000), (73, "zy" * 300), (74, docs[5][1]), (75, docs[5][1]), (76, "z" * 99), (77, "z" * 99), (78, "é" * 60)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, doc_no int").repartition(4)
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffixes.remove_repeats(df).collect()]
    assert sorted(got) == brute_passages(docs)


def test_copies_of_a_passage_are_not_sorted_in_one_block(spark, monkeypatch):
    for name, value in (("HOT_RUNS", 20), ("CHUNK", 700), ("BLOCK", 4000)):
        monkeypatch.setattr(suffixes, name, value)
    sort = suffixes.repeated_windows

    def bounded(bucket, doc, place, more, off, raw, length):
        assert len(raw) <= 100, f"{len(raw)} runs in one block"
        return sort(bucket, doc, place, more, off, raw, length)

    monkeypatch.setattr(suffixes, "repeated_windows", bounded)
    rnd = random.Random(4)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = word(130)
    docs = [(i, word(90) + passage + word(90)) for i in range(400)]
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()]
    assert sorted(got) == brute_passages(docs)


def test_passages_of_null_and_repeated_ids_and_no_rows(spark):
    text = " ".join(str(i * 7919) for i in range(60))
    df = spark.createDataFrame([(None, text), (1, text + "x"), (1, text + "x"), (2, text[5:])], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed) for r in suffixes.remove_repeats(df).collect())
    assert got == [("1", len(text)), ("1", len(text)), ("2", len(text) - 5), ("None", 0)]
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def brute_components(ids, fps, most):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= most:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i, f in zip(ids, fps, strict=True):
        least[root(f)] = min(least.get(root(f), i), i)
    return {i: least[root(f)] for i, f in zip(ids, fps, strict=True)}


@pytest.mark.parametrize("block", [8192, 7])
def test_simhash_components_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rnd = random.Random(5)
    values = [rnd.getrandbits(64) for _ in range(150)] + [0]
    for _ in range(200):
        v = rnd.choice(values)
        for _ in range(rnd.randrange(1, 6)):
            v ^= 1 << rnd.randrange(64)
        values.append(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in set(signed)], "fp long").repartition(4)
    found = common.connected_components(simhash.links(fps)).collect()
    component = {r.node: r.component for r in found}
    want = brute_components(range(len(values)), values, 4)
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(component.get(s, s), set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))


def test_thresholds_add_up_and_no_partition_set_misses():
    cost, chosen = simhash.allocate([{-1: 0, 0: 5, 1: 9}, {-1: 0, 0: 1, 1: 50}, {-1: 0, 0: 2, 1: 3}], 1)
    assert sum(chosen) == 1 and cost == 9


def test_fingerprints_and_odd_documents(spark):
    import xxhash

    def plain(text):
        words = simhash.WORD.findall((text or "").encode().translate(simhash.LOWER))
        if not words:
            return 0
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    long = " ".join(f"w{i}" for i in range(3000))
    texts = [None, "", " \t", "One", "ONE", "a b c", "a b c d", "a b c d e f", "é Ünder x y z", long, long + " tail", long]
    assert [simhash.fingerprint(t) for t in texts] == [plain(t) for t in texts]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "lonely words of nobody else", 7), (3, "One", 7)], "doc_id long, text string, fp int")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert [got[i] for i in (0, 1, 2, 3, 4, 9, 11)] == [0, 0, 0, 3, 3, 9, 9] and got[None] is None
    kept = simhash.keep_first(df)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == df.columns and ids.count(3) == 1 and None in ids and not {1, 2, 4, 11} & set(ids)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_groups_whose_rows_share_an_id_keep_a_row_each(spark):
    one, two = "first words that make one group of copies here", "quite other words for the second group of rows"
    rows = [(3, one, "a"), (3, two, "b"), (4, one, "c"), (5, two, "d"), (3, one, "e"), (3, one, "A"), (None, one, "n"), (9, None, "z"), (9, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, place string")
    for parts in (1, 3):
        got = sorted((r.doc_id or 0, r.text or "", r.place) for r in simhash.keep_first(df.repartition(parts)).collect())
        blank = [r for r in got if not r[1]]
        assert [r for r in got if r[1]] == [(0, one, "n"), (3, one, "A"), (3, two, "b")] and len(blank) == 1 and blank[0][0] == 9
    assert simhash.keep_first(df.limit(0)).columns == df.columns


def test_length_of_passages_is_bounded_by_what_the_content_hash_covers(spark):
    rng = np.random.default_rng(6)
    length, size = suffixes.LONGEST, 2 * suffixes.LONGEST - suffixes.GRAM
    raw = rng.integers(97, 123, size).astype(np.uint8)

    def content(data):
        valid = np.ones(len(data) - length + 1, bool)
        return {(int(b), int(m)): int(c) for b, m, _, _, c in zip(*suffixes.window_runs(data, valid, length), strict=True)}

    before = content(raw)
    for k in range(size):
        changed = raw.copy()
        changed[k] ^= 1
        for (begin, more), c in content(changed).items():
            if (begin, more) in before and begin <= k < begin + more + length:
                assert c != before[begin, more]
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert suffixes.remove_repeats(df, length=length).count() == 1
    with pytest.raises(ValueError):
        suffixes.remove_repeats(df, length=length + 1)
