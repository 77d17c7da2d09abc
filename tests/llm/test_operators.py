"""Each operator on awkward rows against a brute-force version or its stated rules."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wattloom.llm import anchors, ctw, dartminhash, fertility, fuzzylines, packing, pagediff, pulearn, tiling, wordcache, zlang
from wattloom.llm.exchange import pack, pack_sorted, unpack, unpack_sorted

tokenizers_here = pytest.importorskip("public_tokenizers")


def words(text):
    return (text or "").encode().split()


def held(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def test_packed_arrays():
    rng = np.random.default_rng(0)
    for values in (np.zeros(0, np.int64), rng.integers(0, 300, 1000), np.array([-5, 7]), rng.random(10).astype(np.float32)):
        assert (unpack(pack(values)) == values).all()
    rising = np.sort(rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    assert (unpack_sorted(pack_sorted(rising)) == rising).all()


def test_split_words_is_bytes_split(rows):
    texts = [r[1] for r in rows] + [" a\x0bb\xa0c\x1cd \x85 ", "\t", "É x"]
    distinct, at, counts = wordcache.split_words(pa.array(texts))
    assert [distinct[i] for i in at] == [w for t in texts for w in words(t)]
    assert counts.tolist() == [len(words(t)) for t in texts]


def brute_tree(streams, train):
    depth, kt = ctw.DEPTH, lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    seen = [{} for _ in range(depth + 1)]

    def path(s, p):
        node = 1
        for i in range(8):
            yield node, (s[p] >> (7 - i)) & 1
            node = node * 2 + ((s[p] >> (7 - i)) & 1)

    streams = [bytes(depth) + s for s in streams]
    for s, learn in zip(streams, train, strict=True):
        for p in range(depth, len(s)) if learn else ():
            for node, bit in path(s, p):
                for d in range(depth + 1):
                    seen[d].setdefault((s[p - d : p], node), [0, 0])[bit] += 1
    block = {depth: {k: kt(*v) for k, v in seen[depth].items()}}
    for d in range(depth - 1, -1, -1):
        below = Counter()
        for (context, node), v in block[d + 1].items():
            below[context[1:], node] += v
        block[d] = {k: np.logaddexp(math.log(0.5) + kt(*v), math.log(0.5) + below[k]) for k, v in seen[d].items()}
    for s in streams:
        total = 0.0
        for p in range(depth, len(s)):
            for node, bit in path(s, p):
                for d in range(depth, -1, -1):
                    key = (s[p - d : p], node)
                    counts = seen[d].get(key, [0, 0])
                    own = (counts[bit] + 0.5) / (sum(counts) + 1)
                    stop = 1 if d == depth else math.exp(math.log(0.5) + kt(*counts) - block[d][key]) if key in block[d] else 0.5
                    q = own if d == depth else stop * own + (1 - stop) * q
                total += math.log10(q)
        yield total


def test_context_tree(spark, rows):
    some = [r for r in rows if r[0] != 107][:12] + [r for r in rows if r[0] in (100, 101, 102, 104, None)]
    got = ctw.language_scores(spark.createDataFrame([(r[0], r[1], r[4]) for r in some], "doc_id bigint, text string, slice bigint")).collect()
    split = [[w.lower() for w in words(r[1])] for r in some]
    train = [r[0] is not None and not held(r[0], 10, 0) for r in some]
    counts = Counter(w for s, t in zip(split, train, strict=True) if t for w in [*s, None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r, s, score in zip(some, split, brute_tree([b" ".join(s) + b"\n" for s in split], train), strict=True):
        tokens = [*s, None]
        want.append((str(r[0]), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), score))
    have = [(str(x.doc_id), x.n_tokens, x.n_known, x.train_tokens, x.base_score, x.score) for x in got]
    for a, b in zip(sorted(have), sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-5)


def test_fertility(docs, rows):
    got = fertility.fertility_rules(docs, tokenizers_here.path("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in rows:
        w = words(r[1])
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        repeated = len({i + k for i, g in enumerate(grams) if g in twice for k in range(3)})
        lines = [x for x in (r[1] or "").split("\n") if x.split()]
        by_id.setdefault(r[0], []).append((len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in r[1] or ""), len(lines) - len(set(lines)), repeated, len(w) < 50 or 2 * repeated > len(w)))
    for x in got:
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) in by_id[x.doc_id]
        assert not (x.base_failed and x.kept)
    assert sum(x.kept for x in got) >= 0.8 * sum(not x.base_failed for x in got)


def test_language(docs, rows):
    got = zlang.language_id(docs).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 60}
    assert {x.lang_pred for x in got} <= {"en", "de", "und"} and all(0 <= x.score <= 1 for x in got)
    assert all((x.lang_pred == "und") == (x.doc_id in (100, 101, 102, 106)) for x in got if x.doc_id is not None)
    assert np.mean([x.lang_pred == truth[x.doc_id] for x in got if x.doc_id in truth and x.held_out]) > 0.9


def test_pieces_are_those_of_the_tokenizer(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizers_here.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    want = Counter()
    for r in rows:
        ids = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        want.update((r[0], i, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for i, at in enumerate(range(0, len(ids), 2048)))
    cut = packing.pieces(docs, path)
    assert Counter(map(tuple, cut.collect())) == want
    placed = packing.pack(cut, group=16).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == want
    bins = {}
    for r in placed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)])]
        assert [at for at, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in placed) / 2048) + 6


def test_genetic_packing_reaches_a_perfect_packing():
    rng = np.random.default_rng(1)
    sizes = np.concatenate([np.diff(np.sort(np.r_[0, rng.choice(np.arange(1, 100), 2, replace=False), 100])) for _ in range(40)])
    first = packing.evolve(sizes, 100, 0, [], 6, 0)
    best = packing.evolve(sizes, 100, 0, [first], 6, 30)
    assert np.bincount(best, sizes).max() <= 100
    assert best.max() <= first.max() and best.max() + 1 >= packing.least_bins(sizes, 100)


def test_quality(spark, docs, rows, labels, none):
    got = pulearn.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in got)
    empty = labels.where("false")
    assert {x.score for x in pulearn.quality_scores(docs, empty).collect()} == {0.5}
    assert pulearn.good_documents(docs, labels).columns == docs.columns
    assert pulearn.quality_scores(none, labels).count() == 0


def test_repeated_windows(docs, rows):
    ids = [r[0] if r[0] is not None else 1 << 62 for r in rows]
    split = [words(r[1]) for r in rows]
    first = {}
    for i, w in zip(ids, split, strict=True):
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(first.get(g, i), i)
    want = []
    for r, i, w in zip(rows, ids, split, strict=True):
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.append((str(r[0]), len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    assert sorted((str(x.doc_id), x.n_words, x.n_removed, x.kept) for x in anchors.remove_repeats(docs, size=3000).collect()) == sorted(want)
    assert sum(x[2] for x in want) >= 30


def brute_groups(sets, alike):
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if alike(sets[a], sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}


def test_near_duplicates(spark, rows):
    base = rows[30][1].split()
    near = [(200 + i, " ".join([*base[:i], "changed", *base[i + 1 :]])) for i in range(0, len(base), 4)]
    table = [(r[0], r[1]) for r in rows if r[0] not in (30, 107)] + [(199, " ".join(base))] + near
    got = dartminhash.near_duplicates(spark.createDataFrame(table, "doc_id bigint, text string"), crowd=4, block=3)
    tokens = lambda t: [p for w in words(t) for p in tiling.tokens_of(w)]
    sets = {}
    for i, t in table:
        w = tokens(t)
        if i is not None and w:
            sets[i] = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])
    want = brute_groups(sets, lambda a, b: sum((a & b).values()) >= 0.8 * sum((a | b).values()))
    have = got.collect()
    assert len(have) == len(table)
    for x in have:
        assert x.class_id == (want.get(x.doc_id, x.doc_id))
        assert x.kept == (x.doc_id is None or x.class_id == x.doc_id)


def test_one_of_each(docs, rows, none):
    got = [x.doc_id for x in dartminhash.one_of_each(docs).collect()]
    assert set(range(60)) - set(got) == {20, 21} and got.count(5) == 1 and got.count(None) == 2
    assert dartminhash.one_of_each(none).count() == 0


def test_lines_of_one_template_stay(spark):
    """Every two of these lines differ in three of ten words: similarity 0.7, below the limit."""
    lines = [" ".join(["alpha", f"x{i}", "beta", "gamma", f"y{i}", "delta", "eps", f"z{i}", "eta", "theta"]) for i in range(400)]
    near = [lines[5].replace("eps", "other"), lines[7] + " more"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lines + near)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in fuzzylines.dedup_lines(df).collect()}
    assert [i for i, n in got.items() if n] == [400, 401]


def test_lines(spark, rows):
    long = " ".join(f"word{i} other{i}" for i in range(60))
    table = [(r[0], r[1], 9) for r in rows if r[0] != 107] + [(300, f"{long}\nshort\n{long.upper()}!", 9), (301, long.replace("word30", "word31") + "\nno\nno", 9)]
    got = fuzzylines.dedup_lines(spark.createDataFrame(table, "doc_id bigint, text string, n_removed int"), crowd=2)
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    have = {}
    for x in got.collect():
        have.setdefault(x.doc_id, []).append(x)
    assert [(x.text, x.n_lines, x.n_removed) for x in have[300]] == [(f"{long}\nshort", 3, 1)]
    # A changed word among 120 leaves the line similar if the SimHash agrees; the brute force of the catalogue run tells the rest.
    assert have[301][0].text in ("no\nno", long.replace("word30", "word31") + "\nno\nno")
    assert have[20][0].text == "" and have[100][0].text is None and have[100][0].n_lines == 0 and have[101][0].n_lines == 1
    assert {x.text for x in have[None]} == {"", None}
    assert len({x.text for x in have[5]}) == 1 and have[5][0].n_removed == 0


def test_lines_of_an_empty_table(none):
    assert fuzzylines.unique_lines(none).count() == 0


@pytest.mark.parametrize("most_bytes", [32_000_000, 0])
def test_tiling(docs, rows, items, most_bytes):
    got = tiling.decontaminate(docs, items, most_bytes=most_bytes).collect()
    assert len(got) == len(rows)
    bad = {x.doc_id for x in got if x.contaminated}
    assert bad == {7, 9}
    assert {tuple(x["items"]) for x in got if x.contaminated} == {(1, 2)}
    assert all(x.item_id in (1, None) and (x.coverage == 1.0) == x.contaminated for x in got)


def test_greedy_tiles():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 4, 14).astype(np.uint64) * np.uint64(7919), rng.integers(0, 4, 30).astype(np.uint64) * np.uint64(7919)
        in_a, in_b, want = [False] * 14, [False] * 30, 0
        while True:
            best = max(((n, -i, -j) for i in range(14) for j in range(30) for n in [next((k for k in range(15) if i + k >= 14 or j + k >= 30 or in_a[i + k] or in_b[j + k] or a[i + k] != b[j + k]), 0)]), default=(0, 0, 0))
            if best[0] < 3:
                break
            n, i, j = best[0], -best[1], -best[2]
            in_a[i : i + n], in_b[j : j + n], want = [True] * n, [True] * n, want + n
        got = tiling.tiles(a, b, 3)
        assert sum(t[0] for t in got) == want
        assert all((a[i : i + n] == b[j : j + n]).all() for n, i, j in got)


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><nav><a>Home</a></nav>{}<footer>&copy; me</footer></body></html>"


def test_pages(spark):
    menu, note = "<div>All topics</div><p>News of the week</p>", "<p>Imprint and terms</p>"
    pages = [
        (1, "http://a.org/x/1?p=1", PAGE.replace("{}", "<article><h1>One &amp; all</h1><p>Text  of <b>o</b>ne<br>end.<p>Said twice.<p>Said twice.</article><div class='ad box'>Buy</div>")),
        (2, "http://b.org/x/1", PAGE.replace("{}", f"{menu}<p>First story</p><p>told here.</p>{note}")),
        (3, "http://b.org/x/2", PAGE.replace("{}", f"{menu}<p>Second story</p>{note}<div id='comments'><p>Bah</p></div>")),
        (4, "http://b.org/x/2/", PAGE.replace("{}", f"{menu}<p>Second story</p>{note}")),
        (5, "http://c.org/", "<p>alone &lt;here&gt;<script>var t='</p>'</script> still<p>two"),
        (6, None, None), (6, None, None), (None, "http://b.org/y", ""), (7, "nonsense", "no markup"),
    ]
    got = sorted((x.page_id or 0, x.text, x.n_chars) for x in pagediff.main_text(spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, row string")).collect())
    want = [(0, ""), (1, "One & all Text of one end. Said twice. Said twice."), (2, "First story told here."), (3, "Second story"), (4, "Second story"), (5, "alone <here> still two"), (6, ""), (6, ""), (7, "no markup")]
    assert got == [(i, t, len(t)) for i, t in want]


def test_common_is_a_longest_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(100):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 12)).tolist()
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert len(pagediff.common(a, b)) == best[-1][-1]


def test_empty_tables(none, items):
    vocabulary = tokenizers_here.path("word_bpe_49k.json")
    assert ctw.language_scores(none).count() == 0
    assert fertility.fertility_rules(none, tokenizers_here.path("piece_bpe_32k.model")).count() == 0
    assert zlang.language_id(none).count() == 0
    assert dartminhash.near_duplicates(none).count() == 0
    assert anchors.remove_repeats(none).count() == 0
    assert packing.pack(packing.pieces(none, vocabulary)).count() == 0
    assert tiling.decontaminate(none, items).count() == 0


def test_lane_width_leaves_the_simhash_alone(spark):
    lines = [" ".join(f"w{i * k % 97}" for i in range(n)) for n in (3, 40, 97) for k in (1, 5)]
    places = spark.createDataFrame([(i, 0, 0, t) for i, t in enumerate(lines)], "doc bigint, version bigint, pos int, line string")
    narrow, wide = ({x.doc: x.sim for x in fuzzylines.majority(places, 3, lane).collect()} for lane in (fuzzylines.NARROW, fuzzylines.WIDE))
    assert narrow == wide and len(narrow) == len(lines)


def brute_lines(table, least=3):
    """(id, text) to the texts that stay, by edit similarity of all pairs of lines."""
    place = {}
    for i, text in table:
        for at, line in enumerate(text.split("\n")):
            form = " ".join(fuzzylines_normal(line).split(" "))
            if len(form.split(" ")) >= least:
                place.setdefault(form, []).append((i, at))

    def alike(a, b):
        a, b = a.split(" "), b.split(" ")
        if abs(len(a) - len(b)) > 0.2 * max(len(a), len(b)) + 1e-9:
            return False
        row = list(range(len(b) + 1))
        for x in a:
            new = [row[0] + 1]
            for j, y in enumerate(b):
                new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
            row = new
        return row[-1] <= 0.2 * max(len(a), len(b)) + 1e-9

    groups = brute_groups({f: f for f in place}, alike)
    kept = {}
    for form, root in groups.items():
        kept.setdefault(root, []).extend(place[form])
    gone = {p for places in kept.values() for p in places if p != min(places)}
    return {i: "\n".join(line for at, line in enumerate(text.split("\n")) if (i, at) not in gone) for i, text in table}, len(gone)


def fuzzylines_normal(line):
    return "".join(c for c in line.lower().replace("\t", " ").replace("\r", " ") if not 33 <= ord(c) <= 126 or c.isalnum()).strip(" ")


@pytest.mark.parametrize("crowd", [1, 64])
def test_lines_equal_brute_force(spark, crowd):
    rng = np.random.default_rng(3)
    common, texts = [f"c{i}" for i in range(12)], []
    for n in [4, 5, 6, 7, 9, 10, 14, 15, 19, 20, 24, 33, 60, 120] * 3:
        base = [str(rng.choice(common)) if rng.random() < 0.4 else f"w{rng.integers(0, 3000)}" for _ in range(n)]
        texts.append(base)
        for edits in {1, 2, n // 5, n // 5 + 1}:
            line = list(base)
            for at in rng.choice(n, min(edits, n), replace=False):
                how = rng.integers(0, 3)
                line[at] = "" if how == 0 else f"new{rng.integers(0, 10**6)}" if how == 1 else f"{line[at]} add{rng.integers(0, 10**6)}"
            texts.append(" ".join(w for w in line if w).split())
    lines = [" ".join(t) for t in texts]
    order = rng.permutation(len(lines))
    table = [(i, "\n".join(lines[j] for j in order[at : at + 3])) for i, at in enumerate(range(0, len(lines), 3))]
    want, n_gone = brute_lines(table)
    got = fuzzylines.dedup_lines(spark.createDataFrame(table, "doc_id bigint, text string"), crowd=crowd).collect()
    assert {x.doc_id: x.text for x in got} == want and n_gone > 60


def test_marked_pages_are_differenced(spark):
    page = "<div>All topics</div><article><p>Same greeting</p><p>Teaser {0}</p></article><div><p>Body {0} outside</p><p>Imprint</p></div>"
    pages = [(i, f"http://d.org/x/{i}", PAGE.replace("{}", page.format(i))) for i in (1, 2)] + [(3, "http://e.org/x", PAGE.replace("{}", page.format(3)))]
    got = {x.page_id: x.text for x in pagediff.main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert got == {1: "Same greeting Teaser 1 Body 1 outside", 2: "Same greeting Teaser 2 Body 2 outside", 3: "Same greeting Teaser 3"}


def test_short_repeats_go(spark):
    table = [(1, "Home\n\u597d\u597d\u5b66\u4e60\n...\nHome page"), (2, "home!\n\u597d\u597d\u5b66\u4e60\n...\nHome paged")]
    got = fuzzylines.dedup_lines(spark.createDataFrame(table, "doc_id bigint, text string"), short_repeats=True).collect()
    assert {x.doc_id: x.text for x in got} == {1: table[0][1], 2: "...\nHome paged"}
