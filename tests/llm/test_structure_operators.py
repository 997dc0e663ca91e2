"""HTML, chat, joins, neighbours, mixing and the pipeline against brute force, round trips and invariants."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from masterlink.llm import chat, common, html, jaccard, mixing, neighbours

DATA = "/root/testdata/sf0.01"


# HTML


def page(k, paragraphs, host_text="Shared promise to all readers"):
    nav = "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(1 + k % 4))
    body = "".join(f"<p>{p}</p>" if i % 3 else f"<p><b>{p}<br>" for i, p in enumerate(paragraphs))
    extra = '<div class="cookie-notice">We use cookies</div>' if k % 2 else ""
    return (
        f'<!DOCTYPE html><html><head><title>T{k}</title><style>p{{x}}</style><script>var t="</p><article>";</script></head><body><header><h2>Site</h2></header><nav><ul>{nav}</ul></nav>{extra}'
        f'<!-- ad {k} <p>no</p> --><div class="ad">Buy {k}</div><article><h1>Title {k} &amp; more</h1>{body}<p class="x">{host_text}</p></article>'
        f'<section class="comments"><p>Reader {k} says hi</p></section><aside>Side {k}</aside><form>Name <input><textarea>x</textarea></form><footer>&copy; {k}</footer>' + ("</body></html>" if k % 5 else "")
    )


def test_articles_without_boilerplate(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for k in range(60):
        texts = [f"Para {k} {i} {rng.randrange(10**6)}" for i in range(rng.randrange(1, 7))]
        rows.append((k, f"http://www.h{k % 3}.com/{k}", page(k, texts)))
        want[k] = [f"Title {k} & more", *texts]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("main_text", F.lit("old"))
    got = {r["page_id"]: r["main_text"].split("\n\n") for r in html.extract_main_text(df).collect()}
    assert got == want  # the sentence that every page of a host repeats is template


def test_wrappers_hold_optional_and_repeated_groups():
    params = html.HtmlParams()
    a, b, c = (html.items_of(html.parse(s), params)[0] for s in ("<ul><li>x</li><li>y</li></ul><p>same</p>", "<ul><li>z</li></ul><i>new</i><p>same</p>", "<ul></ul><p>same</p>"))
    wrapper = html.align(html.align(a, b, 6), c, 6)
    assert html.regex_of(wrapper) == "<ul>(<li>#text</li>)+?</ul><i>?text?</i>?<p>text</p>"


def test_merging_partial_wrappers_in_any_grouping_keeps_counts():
    params = html.HtmlParams()
    pages = [html.items_of(html.parse(page(k, [f"a{k}", f"b{k}"][: 1 + k % 2])), params)[0] for k in range(12)]
    whole = None
    for p in pages:
        p = html.load(html.dump(p, 6))
        whole = p if whole is None else html.align(whole, p, 6)
    halves = []
    for part in (pages[:5], pages[5:]):
        w = None
        for p in part:
            w = html.load(html.dump(p, 6)) if w is None else html.align(w, html.load(html.dump(p, 6)), 6)
        halves.append(w)
    both = html.align(halves[0], halves[1], 6)
    count = lambda w: sorted(max(s[html.FREQUENT].values()) for s in html.slots(w) if s[html.TEXT] is not None)
    assert 12 in count(whole) and 12 in count(both)


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a\n  b</p><p>&lt;tag&gt; &#233;&nbsp;x</p>", "a b\n\n<tag> é x"),
        ("<div>one<div>two</div>three</div>", "one\n\ntwo\n\nthree"),
        ("<article><p>in</p></article><p>out</p>", "in"),
        ("<main><h1>t</h1><ul><li>a<li>b</ul></main>", "t\n\na\n\nb"),
        ("<p>a<br>b <i>c</i>d", "a b cd"),
        ("<nav>x</nav><div role=navigation>y</div><div hidden>z</div><p>k</p>", "k"),
        ("<div><a href=x>link one</a> <a>link two</a></div><p>text with a <a>link</a> inside</p>", "text with a link inside"),
        ("<article><div class='article-body'>kept</div><div class='share-bar'>no</div></article>", "kept"),
        ("<script>if (a < b) document.write('<p>x</p>')</script><p>a < b</p>", "a < b"),
        ("<p>unclosed <b", "unclosed"),
        ("<div class='has-sidebar'><h1>t</h1><p>kept</p><div class='sidebar'>no</div></div>", "t\n\nkept"),
        ("<article><div class='post-header'><h1>t</h1></div><p>a</p><section id='comments'><article class='comment'><p>no</p></article></section></article>", "t\n\na"),
        ("<section class='comments'><article><p>no</p></article></section><p>yes</p>", "yes"),
        ("<!-- open comment <p>x</p>", ""),
    ],
)
def test_parsing(source, text):
    assert html.Extractor(html.HtmlParams()).extract("h", None, source) == text


def test_html_edge_cases(spark):
    df = spark.createDataFrame([(1, None, "<p>a</p>"), (1, "x", None), (2, "http://a/", ""), (3, "http://a/", "<p>" + "w " * 200_000 + "</p>"), (3, "http://a/", "<p>b</p>"), (4, "http://a/", "<p>x</p>" * 5000)], "page_id bigint, url string, html string")
    out = [(r["page_id"], len(r["main_text"])) for r in html.extract_main_text(df).collect()]
    assert sorted(out) == [(1, 0), (1, 1), (2, 0), (3, 1), (3, 399_999), (4, 14_998)]
    assert html.extract_main_text(df.limit(0)).count() == 0
    joined = html.extract_main_text(df, html.HtmlParams(broadcast_bytes=-1, least_pages=1))
    assert joined.count() == 6


def test_copies_of_a_page_are_no_template(spark):
    """Copies keep heading and paragraphs: where most pages of a host are copies, and where only they have the structure."""
    copy = "<body><article><h1>Copied title</h1><p>First copied text</p><table><tr><td>Copied cell</td></tr></table></article></body>"
    plain = "<body><div><h1>Plain title</h1><p>Plain copied text</p></div></body>"
    other = lambda k: f"<body><article><h1>Title {k}</h1><p>Text {k}</p></article><div>All rights of this site</div></body>"
    pages = {
        "few": [copy] * 40 + [other(k) for k in range(4)],
        "many": [copy] * 80 + [other(k) for k in range(12)],
        "rare": [copy] * 9 + [other(k) for k in range(60)],
        "bare": [plain] * 50 + [f"<body><div><h1>Title {k}</h1><p>Text {k}</p></div><p>All rights of this site</p></body>" for k in range(20)],
    }
    rows = [(host, source) for host, sources in pages.items() for source in sources]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(k, f"http://{h}.com/{k}", s) for k, (h, s) in enumerate(rows)], "page_id bigint, url string, html string").repartition(7)
    for params in (html.HtmlParams(), html.HtmlParams(broadcast_bytes=-1)):
        got = Counter((r["url"].split("/")[2], r["main_text"]) for r in html.extract_main_text(df, params).collect())
        assert [got[f"{h}.com", "Copied title\n\nFirst copied text\n\nCopied cell"] for h in ("few", "many", "rare")] == [40, 80, 9]
        assert got["bare.com", "Plain title\n\nPlain copied text"] == 50
        assert all(got["bare.com", f"Title {k}\n\nText {k}"] == 1 for k in range(20))  # what all others share is template


def test_wrappers_count_distinct_pages(spark):
    sources = [f"<p>same</p><p>text {k % 5}</p>" for k in range(200)]
    df = spark.createDataFrame([(f"http://a.com/{k}", s) for k, s in enumerate(sources)], "url string, html string").repartition(6)
    row = html.infer_wrappers(df).head()
    assert row["pages"] == 5 and [max(x[html.FREQUENT].values()) for x in html.slots(html.load(row["wrapper"]))] == [5]


class ArticleReader(HTMLParser):
    """Blocks of the article element, read by the standard library's parser: the pages of the test tables mark it so."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag == "br":
            self.blocks[-1] += " "
        elif tag not in ("b", "a"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag not in ("b", "a"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_pages_against_a_plain_reader(spark):
    """All pages of two tables; and the wrapper, without any list of tags or classes, gives the same text of most pages."""
    for table, share in (("sf0.1", 0.5), ("sf0.01", 0.1)):
        rows = spark.read.parquet(f"/root/testdata/{table}/pages.parquet")
        got = {r["page_id"]: (r["main_text"], r["by_wrapper"]) for r in html.extract_main_text(rows).collect()}
        alone = {r["page_id"]: (r["main_text"], r["by_wrapper"]) for r in html.extract_main_text(rows, html.HtmlParams(lists=False)).collect()}
        same = 0
        for r in rows.collect():
            reader = ArticleReader()
            reader.feed(r["html"] or "")
            reader.close()
            want = "\n\n".join(t for t in (" ".join(b.split()) for b in reader.blocks) if t)
            assert got[r["page_id"]][0] == want
            same += alone[r["page_id"]] == (want, True)
        assert same >= share * len(got)


def test_wrapper_finds_an_article_without_names(spark):
    """Elements with meaningless names: the region of the long texts is kept, links, short texts and teasers go."""
    rng = random.Random(12)
    words = lambda n: " ".join(f"w{rng.randrange(999)}" for _ in range(n))
    rows, want = [], {}
    for k in range(30):
        texts = [words(rng.randrange(30, 60)) for _ in range(rng.randrange(1, 6))]
        menu = "".join(f"<i><a href='/{j}'>{words(2)}</a></i>" for j in range(rng.randrange(2, 5)))
        body = f"<div class=x1>{menu}</div><div class=x2>{words(3)}</div><div class=x3><div><h1>T{k}</h1></div><div>{''.join(f'<p>{t}</p>' for t in texts)}</div></div><div class=x4><p>{words(4)}</p></div>"
        rows.append((k, f"http://h.com/{k}", f"<html><body>{body}</body></html>"))
        want[k] = "\n\n".join([f"T{k}", *texts])
    rows.append((99, "http://h.com/other", "<table><tr><td>Own structure</td></tr></table>"))
    want[99] = "Own structure"
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = html.extract_main_text(df).collect()
    assert {r["page_id"]: r["main_text"] for r in out} == want
    assert sorted(r["page_id"] for r in out if not r["by_wrapper"]) == [99]


def test_template_lines_are_counted_exactly_however_many(spark):
    """Twelve lines that all pages share in one repeated group go; headings that all share, captions and ids stay."""
    lines = "".join(f"<p>Shared line {j}</p>" for j in range(12))
    rows = []
    for k in range(20):
        own = "".join(f"<p>Own {k} {j}</p>" for j in range(k % 4 + 1))
        rows.append((k, f"http://h.com/{k}", f"<body><article><h1>T{k}</h1>{own}{lines}<h2 id='warning-signs'>Summary</h2><figure><figcaption>Caption {k}</figcaption></figure></article></body>"))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    want = {k: "\n\n".join([f"T{k}", *(f"Own {k} {j}" for j in range(k % 4 + 1)), "Summary", f"Caption {k}"]) for k in range(20)}
    for n in (1, 9):
        assert {r["page_id"]: r["main_text"] for r in html.extract_main_text(df.repartition(n)).collect()} == want


def test_equal_pages_keep_their_article(spark):
    source = "<body><nav><a>x</a></nav><article><h1>Title</h1><p>One article</p></article></body>"
    for n in (1, 7, 9, 30):
        df = spark.createDataFrame([(k, f"http://h.com/{k}", source) for k in range(n)], "page_id bigint, url string, html string")
        assert {r["main_text"] for r in html.extract_main_text(df).collect()} == {"Title\n\nOne article"}


def test_long_streams_are_aligned_in_bounded_room():
    a, b = tuple(f"k{i % 997}x{i}" for i in range(30_000)), tuple(f"k{i % 997}x{i}" for i in range(0, 30_000, 2))
    found = html.common_subsequence(a, b, 1000)
    assert found and all(a[i] == b[j] for i, j in found) and all(x < y for u, v in itertools.pairwise(found) for x, y in zip(u, v, strict=True))
    assert html.common_subsequence("abcde", "xbyde", 100) == [(1, 1), (3, 3), (4, 4)]


def test_alignment_does_not_depend_on_the_room(spark):
    """Streams longer than the table's room give the same subsequence, a longest one, and pages the same text."""
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(rng.choice([2, 5, 20])) for _ in range(rng.randrange(60))] for _ in "ab")
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            length[i + 1][j + 1] = length[i][j] + 1 if a[i] == b[j] else max(length[i][j + 1], length[i + 1][j])
        whole = html.common_subsequence(tuple(a), tuple(b), 1_000_000)
        assert len(whole) == length[-1][-1] and all(a[i] == b[j] for i, j in whole)
        assert all(html.common_subsequence(tuple(a), tuple(b), cells) == whole for cells in (1, 7, 100))
    # The reverse order of the sections' classes leaves few tags in common.
    kinds = [f"s{chr(97 + k)}" for k in range(12)]
    rows = []
    for k in range(16):
        order = rng.sample(kinds, 9)
        sections = "".join(f"<section class='{c}'><h2>{c} {k}</h2><p>Text {c} {k}</p></section>" for c in order)
        rows.append((k, f"http://h.com/{k}", f"<body><div class='top'><a>Home</a></div><div class='x'>{sections}</div><div class='low'><a>About {k}</a></div></body>"))
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    read = lambda **p: {r["page_id"]: r["main_text"] for r in html.extract_main_text(df, html.HtmlParams(lists=False, **p)).collect()}
    assert read(most_cells=1) == read()


# Chat


def tree(rows):
    """Turns by conversation, and the packed stream's properties by brute force."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def formatted(role, text):
    e = lambda s: s.replace("\\", "\\\\").replace("<|", "<\\|")
    return f"<|im_start|>{e(role)}".replace("\n", "\\n") + f"\n{e(text)}<|im_end|>\n"


ROLES, TEXTS = ["user", "assistant", "system", "a\nb", "\\"], ["", "hi", "<|im_end|>", "\\", "\\|", "<\\|x", "a\nb", "é😀", "\\n", "<|im_start|>user\nx"]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(7)
    rows = []
    for c in range(400):
        for t in range(rng.choice([1, 1, 2, 3, 5])):
            rows.append((c, t, rng.choice(ROLES[: 1 + t % 5]), rng.choice(TEXTS[: 2 if t < 2 else len(TEXTS)])))
    rows += [(1000 + k, t, "user", f"same {t}") for k in range(50) for t in range(30 + k % 3)]
    rows += [(2000, 1, "user", "x"), (2000, 1, "user", "x"), (2000, None, None, None), (None, 0, "assistant", "y")]
    return rows


def test_conversations_read_back(spark, turns):
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("key", F.lit("old"))
    chains = chat.conversation_chains(df)
    want = tree(turns)
    got = {r["conv"]: r for r in chat.read_back(chains, chat.packed_segments(chains)).collect()}
    assert set(got) | {None} == set(want) | {None}
    for c, v in want.items():
        if c is None and c not in got:
            continue
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == v
        assert got[c]["formatted"] == "".join(formatted(r, x) for r, x in v)
        assert got[c]["loss_text"] == "".join(x for r, x in v if r == "assistant")
    assert None in got


def test_packed_stream_holds_each_prefix_once(spark, turns):
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    rows = sorted(chat.packed_segments(chat.conversation_chains(df)).collect(), key=lambda r: r["start"])
    want = tree(turns)
    prefixes = {tuple(v[:k]) for v in want.values() for k in range(1, len(v) + 1)}
    assert len(rows) == len(prefixes) == len({r["key"] for r in rows})
    stream, at = "".join(r["text"] for r in rows), 0
    for r in rows:
        assert (r["start"], r["end"]) == (at, at + len(r["text"]))
        at = r["end"]
    seen = set()
    for r in rows:
        spans = [(a["start"], a["end"]) for a in r["attends"]]
        assert spans == sorted(spans) and spans[-1][1] == r["end"]
        path = "".join(stream[a:b] for a, b in spans)
        assert len(path) == r["position"] + len(r["text"]) and path.endswith(r["text"])
        seen.add(path)
    assert seen == {"".join(formatted(x, y) for x, y in p) for p in prefixes}


def test_no_conversations(spark):
    chains = chat.conversation_chains(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))
    segments = chat.packed_segments(chains)
    assert segments.count() == 0 and chat.read_back(chains, segments).count() == 0


# Jaccard


def brute_components(rows, n=5):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min(x for x in (least.get(r), d) if x is not None) if (least.get(r), d) != (None, None) else None
    return Counter((d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows))


def near_copies(seed, docs, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    rows = []
    for _ in range(docs):
        if rows and rng.random() < 0.65:
            w = (rng.choice(rows[:6] if rng.random() < 0.6 else rows)[1] or "a").split()
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                k = rng.randrange(len(w))
                w[k : k + rng.randrange(0, 2)] = [rng.choice(vocabulary)]
        else:
            w = rng.choices(vocabulary, k=rng.choice([0, 1, 2, 4, 5, 6, 9, 30, 80]))
        rows.append((rng.randrange(10**6), rng.choice([" ", "  ", "\n"]).join(x.upper() if rng.random() < 0.2 else x for x in w)))
    return rows


@pytest.mark.parametrize(("seed", "words", "params"), [(1, 500, {}), (2, 6, {}), (3, 300, {"run_rows": 7, "range_shingles": 300, "common": 3, "slice_bytes": 3000, "keys": 1}), (4, 40, {"run_rows": 5, "keys": 1, "common": 2})])
def test_components_against_all_pairs(spark, seed, words, params):
    rows = [*near_copies(seed, 350, words), (None, "a b c d e f g"), (7, "a b c d e f g"), (8, None), (8, None), (9, "same"), (9, "SAME"), (10, "x " * 4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("cls", F.lit("old")).repartition(3)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, jaccard.JaccardParams(**params)).collect())
    want = brute_components(rows)
    assert got == want
    assert len({c for _, _, c in want}) < len(rows) - 20


@pytest.mark.parametrize("params", [{}, {"keys": 1}, {"keys": 1, "run_rows": 40}, {"keys": 1, "piece_bytes": 20_000}])
def test_large_families_give_few_pairs(spark, monkeypatch, params):
    """Near copies on both sides of a size band's border are all linked, by no more pairs than a multiple of their number."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(61)]
    rows = [(k, " ".join([f"own{k}", *base[1 : 60 + k % 2]])) for k in range(240)]
    rows += [(1000 + k, " ".join(w if rng.random() < 0.97 else f"x{rng.randrange(10**6)}" for w in base)) for k in range(120)]
    most = []
    cut = jaccard.durable

    def durable(df):
        df = cut(df)
        if df.columns[:2] == ["a", "b"]:
            most.append(df.count())
        return df

    monkeypatch.setattr(jaccard, "durable", durable)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, jaccard.JaccardParams(**params)).collect())
    assert got == brute_components(rows)
    assert max(most) < 12 * len(rows)


def test_bitmap_bounds_the_overlap_from_above():
    rng = np.random.default_rng(3)
    for _ in range(300):
        both = rng.integers(0, 1 << 62, rng.integers(0, 300)).astype(np.uint64)
        a, b = (np.unique(np.concatenate((both, rng.integers(0, 1 << 62, rng.integers(0, 300)).astype(np.uint64)))) for _ in "ab")
        bits = np.stack([jaccard.bitmap(a), jaccard.bitmap(b)])
        bound = jaccard.bound_of(bits, np.array([len(a), len(b)]), 1, slice(0, 1))[0]
        assert jaccard.overlap(a, b) == len(np.intersect1d(a, b)) <= bound


def test_shingles_that_agree_in_many_bits_are_told_apart(spark):
    """One-word texts whose shingles agree in the low 40 bits are not linked, in one range or many."""
    low: dict[int, str] = {}
    twins = []
    for a in range(0, 4_000_000, 100_000):
        words = [f"t{k}" for k in range(a, a + 100_000)]
        data, offsets = common.buffer_of(pa.array(words, pa.large_string()))
        for i, j in common.slices(offsets):
            w = common.Words(data, offsets, i, j)
            h = common.grams(w.hash, 1) ^ common.U64(0x5DEECE66D)
            for word, x in zip(words[i:j], (h & common.U64((1 << 40) - 1)).tolist(), strict=True):
                if x in low:
                    twins.append((low[x], word))
                low[x] = word
    assert twins
    rows = [(k, t) for k, t in enumerate(t for pair in twins for t in pair)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for params in (jaccard.JaccardParams(), jaccard.JaccardParams(common=2, growth_bytes=1.0)):
        assert {(r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(df, params).collect()} == {(k, k) for k, _ in rows}


def test_jaccard_of_no_rows(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# Neighbours


def brute_neighbours(vectors, queries, k=20):
    out = {}
    for q in queries:
        scores = [(-float((vectors[q] * x).sum()), i) for i, x in vectors.items() if i != q]
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_neighbours_recall_and_order(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    found = defaultdict(list)
    for r in neighbours.nearest_neighbours(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows.collect()}
    want = brute_neighbours(vectors, [i for i in vectors if i % 20 == 0])
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, v in found.items():
        assert v == sorted(v, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float((vectors[q] * vectors[i]).sum()), abs=1e-12) for i, s in v)


def test_neighbours_are_exact_when_all_lists_are_probed(spark):
    rng = np.random.default_rng(8)
    vectors = {int(i): (rng.normal(size=12) * rng.choice([0.1, 1, 9])).astype(np.float32).astype(np.float64) for i in range(700)}
    vectors |= {i: vectors[40] for i in range(1000, 1300)}  # a hot vector
    rows = [(i, v.tolist()) for i, v in vectors.items()]
    odd = [(5000, None), (5001, [0.0] * 12), (5002, [float("nan")] * 12), (5003, [None] * 12), (5004, [1.0]), (5005, [float("inf")] * 12), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("list", F.lit("old"))
    params = neighbours.NeighbourParams(probed_share=1.0, tile_rows=100, query_rows=9, strictness=50.0)
    found = defaultdict(list)
    for r in neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, params).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    want = brute_neighbours(vectors, [i for i in vectors if i % 20 == 0])
    assert {q: [i for i, _ in v] for q, v in want.items()} == found


def test_doubles_keep_their_digits_and_lengths_stay_apart(spark):
    rng = np.random.default_rng(9)
    vectors = {int(i): rng.normal(size=6) for i in range(300)}
    vectors |= {1000 + int(i): rng.normal(size=3) + 1e-9 for i in range(90)}
    vectors[7] = vectors[20] + 1e-12  # floats would not tell them apart
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    out = neighbours.nearest_neighbours(df, F.col("vec_id") % 20 == 0, neighbours.NeighbourParams(probed_share=1.0, strictness=50.0)).collect()
    for lo, hi in ((0, 1000), (1000, 2000)):
        own = {i: v for i, v in vectors.items() if lo <= i < hi}
        for q, want in brute_neighbours(own, [i for i in own if i % 20 == 0]).items():
            got = [(r["vec_id"], r["score"]) for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q]
            assert [i for i, _ in got] == [i for i, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-15)


@pytest.mark.parametrize("table", ["sf0.1", "check_s"])
def test_recall_on_larger_tables(spark, table):
    """With centroids in two levels on the first; each query counts, against all products."""
    rows = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    params = neighbours.NeighbourParams(flat_lists=20) if table == "sf0.1" else neighbours.NeighbourParams()
    found = defaultdict(set)
    for r in neighbours.nearest_neighbours(rows, F.col("vec_id") % 20 == 0, params).collect():
        found[r["query_id"]].add(r["vec_id"])
    kept = [(r["vec_id"], r["embedding"]) for r in rows.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").collect()]
    kept = [(i, v) for i, v in kept if None not in v and np.isfinite(v).all() and np.any(v) and len(v) == len(kept[0][1])]
    ids, x = np.array([i for i, _ in kept]), np.array([v for _, v in kept], dtype=np.float64)
    hits = total = 0
    for q in np.unique(ids[ids % 20 == 0]):
        score = x @ x[np.flatnonzero(ids == q)[0]]
        score[ids == q] = -np.inf
        want = set(ids[np.argsort(-score, kind="stable")[:20]].tolist())
        hits, total = hits + len(want & found[int(q)]), total + len(want)
    assert total > 1000 and hits >= 0.9 * total


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (0, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    out = [(r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest_neighbours(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert out == [(0, 1, 2), (0, 2, 1)]
    assert neighbours.nearest_neighbours(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest_neighbours(df.filter("vec_id = 1"), F.lit(True)).count() == 0


# Mixing


@pytest.mark.parametrize("weights", [{"a": 5.0, "b": 3.0, "c": 2.0}, {"a": 1.0, "b": 1.0, "c": 0.013}, {"a": 0.7, "b": 0.29, "c": 0.01}])
def test_schedule_stays_within_a_block_of_the_weights(spark, weights):
    sizes = {"a": 900, "b": 500, "c": 300}
    rows = [(i * 7 + k, s) for k, s in enumerate(sizes) for i in range(sizes[s])]
    df = spark.createDataFrame(rows, "doc_id bigint, source string").withColumn("mix_slot", F.lit("old"))
    params = mixing.MixParams(block_rows=4, period=60, range_rows=100)
    out = mixing.mix_sources(df, weights, params).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _ in rows)
    total = sum(weights.values())
    units = {s: max(1, round(w / total * 60)) for s, w in weights.items()}
    period = sum(units.values())
    slots = defaultdict(set)
    for r in out:
        assert r["mix_release"] <= r["mix_slot"] < r["mix_deadline"]
        slots[r["mix_slot"]].add((r["source"], r["mix_block"]))
    assert all(len(v) == 1 for v in slots.values())
    blocks = Counter(s for v in slots.values() for s, _ in v)
    assert blocks == {s: -(-n // 4) for s, n in sizes.items()}
    done = Counter()
    for t in range(max(slots) + 1):
        for s, _ in slots.get(t, ()):
            done[s] += 1
        for s in sizes:
            if done[s] < blocks[s]:  # has not run out
                assert abs(done[s] - (t + 1) * units[s] / period) < 1
    places = Counter((r["source"], r["mix_block"], r["mix_offset"]) for r in out)
    assert max(places.values()) == 1


@pytest.mark.parametrize(
    ("weights", "sizes", "params"),
    [
        ({"a": 0.5003, "b": 0.4997}, {"a": 5003, "b": 4997}, {}),
        ({"a": 0.6, "b": 0.3998, "c": 0.0002}, {"a": 6000, "b": 3998, "c": 2}, {"broadcast_slots": 0}),
        ({"a": 1 / 3, "b": 1 / 3, "c": 0.1234567890123, None: 0.2}, {"a": 300, "b": 700, "c": 250, None: 100}, {}),
        ({f"s{k}": 1.0 + k / 7 for k in range(12)}, {f"s{k}": 40 + 3 * k for k in range(12)}, {}),
    ],
)
def test_schedule_stays_within_a_block_of_the_given_weights(spark, weights, sizes, params):
    """Against exact fractions of the given weights, for each slot until a source runs out."""
    rows = [(i * 20 + k, s) for k, s in enumerate(sizes) for i in range(sizes[s])]
    df = spark.createDataFrame(rows, "doc_id bigint, source string")
    out = mixing.mix_sources(df, weights, mixing.MixParams(block_rows=1, range_rows=100, **params)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(d for d, _ in rows)
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total = sum(exact.values())
    at = {r["mix_slot"]: r["source"] for r in out}
    assert len(at) == len(rows)
    done = Counter()
    for t in range(max(at) + 1):
        if t in at:
            done[at[t]] += 1
        for s in sizes:
            if done[s] < sizes[s]:
                assert abs(done[s] - (t + 1) * exact[s] / total) < 1


def test_columns_with_names_of_the_mixture(spark):
    names = ["before", "slots", "range", "n", "c", "p", "block", "slot", "source_", "key"]
    df = spark.createDataFrame([(k, f"s{k % 3}") for k in range(50)], "doc_id bigint, source string").withColumns({n: F.lit(n) for n in names})
    out = mixing.mix_sources(df)
    assert out.columns == [*df.columns, *mixing.NEW]
    assert out.count() == 50 and all(r[n] == n for r in out.collect() for n in names)


def test_mixing_edge_cases(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, "a"), (None, "a"), (3, "a")], "doc_id bigint, source string")
    out = mixing.mix_sources(df)
    assert out.count() == 5
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert mixing.mix_sources(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="weight"):
        mixing.mix_sources(df, {"a": 1.0})
    with pytest.raises(ValueError, match="max_sources"):
        mixing.mix_sources(df, params=mixing.MixParams(max_sources=1))


# Pipeline


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(11)
    words = "the of and to in that is was for with are this have from by".split()
    text = lambda n: " ".join(rng.choices(words, k=n)) + f" end{rng.randrange(10**9)}"
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    base = text(60)
    rows = [(i, text(40), "en", f"s{i % 3}", 1) for i in range(10, 40)]
    rows += [(50, base, "en", "s0", 1), (51, base, "en", "s0", 1), (52, base + " more", "en", "s1", 1), (60, text(20) + " " + passage, "en", "s0", 1)]
    rows += [(70, text(30) + " password=abc12345 x", "en", "s0", 1), (80, None, "en", "s0", 1), (81, "123 456", "en", "s0", 1), (None, text(30), "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet")).withColumn("extra", F.lit(1))
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        now = spark.read.parquet(str(tmp_path / str(k)))
        assert now.columns[:5] == corpus_pipeline.COLUMNS and (name == "mixing" or len(now.columns) == 5)
        kept.append({r["doc_id"] for r in now.collect()})
    ids = {r[0] for r in rows}
    assert kept[0] == ids - {80, 81}
    assert kept[1] == kept[0] - {51, 52}
    assert kept[2] == kept[1] - {60}
    assert kept[3] == kept[4] == kept[2]
    redacted = now.filter("doc_id = 70").head()
    assert "[SECRET] x" in redacted["text"] and "abc12345" not in redacted["text"] and redacted["n_chars"] == len(redacted["text"])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == kept[4]


def test_near_copies_leave_one_row(spark):
    """Equal rows, rows of one key with other texts, and null keys: one row of each linked group stays, against all pairs."""
    base = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"term{i}" for i in range(40))
    third = " ".join(f"unit{i}" for i in range(9))
    rows = [(1, base, "en", "s", 1)] * 3 + [(1, other, "en", "s", 1), (2, base + " end", "en", "s", 1), (None, other, "en", "s", 1), (None, third, None, None, None), (None, third, None, None, None), (None, third.upper(), None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").withColumn("extra", F.lit(1)).repartition(3)
    out = Counter((r["doc_id"], (r["text"] or "").lower()) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert out == Counter([(1, base), (1, other), (None, third), (7, "")])


def test_pipeline_without_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
