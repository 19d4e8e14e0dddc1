"""Operators on pages and conversations against plain versions."""

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import pytest

from hourloom.llm import chat_trees, components, hnsw, page_text, queries, url_filters
from hourloom.llm.storage import discard, stored
from tests.llm.helpers import words

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, host string, template string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES)


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in page_text.main_texts(pages(spark, rows)).collect()}


def test_main_text_of_one_page(spark):
    article = (
        "<h1>A&amp;B</h1><p>One <b>bold</b>\n two&nbsp;three<br>next<p>open <i>paragraph<ul><li>x<li>y</ul>"
        "<script>var a='</p><p>no</p>';</script><div class='share-bar'>Share</div><section id=comments>me too</section>"
    )
    html = (
        "<!DOCTYPE html><html><head><title>T</title></head><body><header>H</header><nav><a>N</a></nav><div class=ad>Buy</div>"
        f"<article>{article}</article><aside>S</aside><form>F<input></form><footer>&copy; F</footer>"
    )
    rows = [(1, "http://a.b/x", html), (2, None, "plain <b>text</b>"), (3, "x", None), (4, "http://a.b/", ""), (5, "u", "<p>cut <a hr")]
    got = texts(spark, rows)
    assert got[1] == "A&B\nOne bold two three\nnext\nopen paragraph\nx\ny"
    assert got[2] == "plain text" and got[3] == got[4] == "" and got[5] == "cut"
    assert texts(spark, []) == {}


def test_wrapper_of_a_host_is_learned(spark):
    """A frame without telling names is template by its repetition; the article is what varies."""
    rows = []
    for i in range(12):
        body = f"<div><div>Home of things</div><div><p>{words(12, i)}</p><p>{words(9, 100 + i)}</p></div><div>Made by us</div></div>"
        rows.append((i, f"http://www.site.org/{i}", f"<html><body>{body}</body></html>"))
    rows += [(100 + i, "http://copy.org/x", rows[0][2]) for i in range(9)]  # copies of one page prove nothing
    got = texts(spark, rows)
    for i in range(12):
        assert got[i] == f"{words(12, i)}\n{words(9, 100 + i)}"
    assert got[100] == f"Home of things\n{words(12, 0)}\n{words(9, 100)}\nMade by us"


def test_varying_text_inside_constant_text_stays(spark):
    bodies = [
        lambda i: f"<article>Loose<p>Note: <em>{words(6, i)}</em> end</p><table><td>Price: <span>{i}0</span></table></article>",
        lambda i: f"Loose<main>Also loose<div>More<p>{words(6, i)}</p></div></main>",
        lambda i: f"<div>Frame<div><div>Label<p>{words(6, i)}</p></div></div></div>",
    ]
    rows = [(10 * k + i, f"http://h{k}.org/{i}", f"<body>{body(i)}") for k, body in enumerate(bodies) for i in range(5)]
    got = texts(spark, rows)
    for i in range(5):
        assert got[i] == f"{words(6, i)}\n{i}0"
        assert got[10 + i] == got[20 + i] == words(6, i)


def test_edited_copies_of_one_article_are_no_template(spark):
    paragraphs = [words(40, 900 + k) for k in range(3)]
    article = "".join(f"<p>{p}</p>" for p in paragraphs)
    rows = []
    for i in range(12):
        rows.append((i, f"http://a.org/{i}", f"<body><article>{article}<p>Written on day {i}</p></article></body>"))
        own = article if i < 10 else "".join(f"<p>{words(40, 10 * i + k)}</p>" for k in range(3))
        rows.append((100 + i, f"http://b.org/{i}", f"<body><div>Frame</div><div>{own}<p>{words(2, i)}</p></div></body>"))
    rows += [(200 + i, f"http://c.org/{i}", f"<body><main>{article}<p>By writer{i}</p></main></body>") for i in range(3)]
    got = texts(spark, rows)
    for i in range(12):
        assert got[i] == "\n".join([*paragraphs, f"Written on day {i}"])
        own = paragraphs if i < 10 else [words(40, 10 * i + k) for k in range(3)]
        assert got[100 + i] == "\n".join([*own, words(2, i)])
    assert [got[200 + i] for i in range(3)] == ["\n".join([*paragraphs, f"By writer{i}"]) for i in range(3)]


def tree(matcher, nested):
    page = page_text.Page()

    def add(node, up):
        label, children = node
        page.labels.append(label)
        page.parents.append(up)
        page.children.append([])
        page.names.append("")
        own = len(page.labels) - 1
        page.children[up].append(own)
        for c in children:
            add(c, own)

    add(nested, 0)
    return page, matcher.shaped(page)


def plain_matching(a, b):
    """Nodes of the largest simple tree matching, by the recurrence."""
    if a[0] != b[0]:
        return 0
    best = {}
    for i in range(len(a[1]) + 1):
        for j in range(len(b[1]) + 1):
            best[i, j] = 0 if not i or not j else max(
                best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + plain_matching(a[1][i - 1], b[1][j - 1])
            )
    return 1 + best[len(a[1]), len(b[1])]


def test_simple_tree_matching():
    rng = np.random.default_rng(1)

    def grown(depth):
        return ("ab"[rng.integers(2)], [grown(depth - 1) for _ in range(rng.integers(0, 4))] if depth else [])

    for _ in range(60):
        a, b, m = ("r", [grown(3) for _ in range(3)]), ("r", [grown(3) for _ in range(3)]), page_text.Matcher()
        (one, s), (two, t) = tree(m, a), tree(m, b)
        assert m.weight(s[1], t[1]) == plain_matching(a, b) == len(m.align(one, s, two, t)) - 1


def test_long_and_deep_pages(spark):
    long = "<article>" + "".join(f"<p>{i}</p>" for i in range(20_000)) + "</article>"
    deep = "<div>" * 3000 + "core"
    got = texts(spark, [(1, "http://h/1", long), (2, "http://h/2", deep), (3, "http://h/3", long.replace("<p>", "<div>"))])
    assert got[1] == "\n".join(map(str, range(20_000))) and got[2] == "core"


def test_elements_below_the_depth_limit_end_where_they_end():
    down, up = "<div>" * 300, "</div>" * 300
    page = f"<div><article>first{down}core<nav>menu<form>field</form>more</nav>on{up}<p>rest</p></article></div><p>outside</p>"
    assert page_text.main_text(page_text.parse(page), set()) == "first\ncore\non\nrest"


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]


def test_urls_aliases_and_rules(spark):
    canonical = '<html><head><LINK href="{}" rel=canonical></head>'
    refresh = "<meta content='0; url={}' http-equiv='refresh'>"
    rows = [
        (1, "http://Example.COM/en/a?x#y", None),
        (2, "http://www.example.com/en/a", ""),
        (3, "http://b.org/p", canonical.format("https://example.com/en/z")),
        (4, "http://c.org/q", refresh.format("http://b.org/p")),
        (5, "http://d.org/dir/r", canonical.format("s")),
        (6, "http://d.org/dir/s", refresh.format("//e.net/es/1")),
        (7, "http://x.com/en/", canonical.format("http://b.org/p")),
        (8, None, canonical.format("http://b.org/p")),
        (9, "no scheme/en/", None),
        (10, "http://notexample.org", None),
        (11, "ftp://e.net?q=/es/", "<link rel=canonical>"),
        (3, "http://b.org/p", canonical.format("https://example.com/en/z")),
    ]
    rules = spark.createDataFrame(RULES + [("com", "/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filters.judged(pages(spark, rows), rules).collect()}
    assert got[1] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert [got[i][2:] for i in (3, 4, 5, 6)] == [(None, "block")] * 4
    assert got[7][2:] == ("com/", "allow")  # a rule of its own stands
    assert got[8] == ("", "", None, "allow") and got[9] == ("", "", None, "allow")
    assert got[10] == ("notexample.org", "", None, "allow") and got[11] == ("e.net", "", None, "allow")
    more = spark.createDataFrame([("http://notexample.org", "http://d.org/dir/r")], "source string, target string")
    again = {r["page_id"]: r["verdict"] for r in url_filters.judged(pages(spark, rows), rules, more).collect()}
    assert again[10] == "block"
    assert url_filters.judged(pages(spark, []), rules).collect() == []


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(6000, 6300)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    frame = spark.createDataFrame(edges + [(None, 1), (2, 2)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(frame).collect()}
    assert got == {x: find(x) for x in up}
    assert components.components(frame.where("false")).collect() == []


def told(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


NASTY = ["", "\\", "</turn>", "\n</turn>\n", "\\</turn", '<turn role="user">\n', "x\\\n", "\\\\<turn\\", "\n", '%22"<\n']


def test_template_is_reversible():
    for turns in itertools.product([("user", a) for a in NASTY] + [(a, "t") for a in NASTY], repeat=2):
        whole, _, _ = chat_trees.formatted(list(turns))
        assert chat_trees.read_back(whole) == list(turns)
    whole, starts, lengths = chat_trees.formatted([("user", "a"), *(("assistant", n) for n in NASTY)])
    assert [chat_trees.unescaped(whole[s : s + n]) for s, n in zip(starts, lengths)] == NASTY


def test_reply_trees_choose_the_best_branches(spark):
    rng = np.random.default_rng(4)
    rows, plain = [], {}
    for t in range(30):
        parent, score = {0: None}, {0: 0.0}
        for m in range(1, int(rng.integers(2, 25))):
            parent[m], score[m] = int(rng.integers(0, m)), round(float(rng.random()), 3)
        rows += [(t, m, parent[m], score[m], "assistant" if m % 2 else "user", f"{t}.{m}") for m in parent]
        found = []
        for leaf in set(parent) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            found.append((-sum(score[m] for m in path) / len(path), leaf, [f"{t}.{m}" for m in path[::-1]]))
        plain[t] = sorted(found)[:2]
    schema = "tree_id long, message_id long, parent_id long, score double, role string, text string, branch int"
    frame = spark.createDataFrame([(*r, 9) for r in rows], schema)
    got = {}
    for r in chat_trees.paths(frame, 2).collect():
        got.setdefault(r["tree_id"], {})[r["branch"]] = (r["leaf_id"], [x["text"] for x in r["turns"]])
    for t, best in plain.items():
        assert [got[t][b] for b in sorted(got[t])] == [(leaf, texts_) for _, leaf, texts_ in best]


def test_awkward_messages(spark):
    rows = [
        (None, 1, None, None, None, None),
        (1, 1, 77, 1.0, "user", "orphan"),
        (1, 2, 1, 1.0, "assistant", "a"),
        (1, 2, 1, 1.0, "assistant", "a"),
        (1, 3, 2, 0.0, "user", "b"),
        (2, 1, 2, 1.0, "user", "cycle"),
        (2, 2, 1, 1.0, "user", "cycle"),
        (2, 3, 1, 1.0, "user", "below"),
        (3, None, None, 1.0, "assistant", "no id"),
        (4, 1, None, 0.0, "user", words(20_000, 1)),
    ]
    frame = spark.createDataFrame(rows, "tree_id long, message_id long, parent_id long, score double, role string, text string")
    got = sorted((str(r["tree_id"]), [t["text"] for t in r["turns"]]) for r in chat_trees.paths(frame, 9).collect())
    assert got == [("1", ["orphan", "a"]), ("1", ["orphan", "a", "b"]), ("3", ["no id"]), ("4", [rows[-1][-1]]), ("None", [""])]
    assert chat_trees.conversations(frame.where("false")).collect() == []
    assert len(chat_trees.read_digests(chat_trees.conversations(frame, 9)).collect()) == 5


def test_registered_chats_read_back(spark):
    plain = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        plain.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    odd = r"\### Assistant: </turn> ok"
    plain[-7] = [("user", odd), ("assistant", odd)]
    got = {r["conv_id"]: r for r in queries.QUERIES["op2_chat_trees"](spark, SF).collect()}
    assert set(got) == set(plain)
    for key, turns in plain.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[key]["n_turns"], got[key]["turns_sha256"]) == (len(turns), told(turns))
        assert (got[key]["loss_chars"], got[key]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def plain_links(rows, threshold=0.98):
    out, n = {}, len(rows)
    unit = [None] * n
    for i, (key, v, label) in enumerate(rows):
        if key is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            unit[i] = x / np.linalg.norm(x)
    links, up = [0] * n, list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return [(rows[i][0], links[i], least[find(i)] if rows[i][0] is not None else None) for i in range(n)]


@pytest.mark.parametrize("shard", [4096, 60])
def test_embedding_links_equal_all_pairs(spark, shard):
    rng = np.random.default_rng(6)
    rows = []
    for c in range(30):
        centre = rng.normal(size=16)
        for _ in range(12):
            rows.append((len(rows), [float(x) for x in np.float32(centre + rng.normal(size=16) * 0.06)], c % 3))
    rows += [(1000 + i, rows[0][1], 0) for i in range(40)]  # copies
    inf, nan = float("inf"), float("nan")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    rows += [(2000 + i, v, 0) for i, v in enumerate(odd)] + [(3000, rows[0][1], None), (None, rows[0][1], 0), (1000, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = hnsw.near_duplicates(frame, shard=shard)
    key = lambda r: tuple((v is not None, v) for v in r)
    found = sorted((tuple(r)[:3] for r in got.collect()), key=key)
    want = sorted(plain_links(rows), key=key)
    assert len(found) == len(want)
    assert sum(f[1] for f in found) >= 0.995 * sum(w[1] for w in want)
    assert sum(f == w for f, w in zip(found, want)) >= 0.98 * len(want)
    assert hnsw.near_duplicates(frame.where("false")).collect() == []


def test_graph_finds_what_brute_force_finds():
    rng = np.random.default_rng(7)
    v = np.repeat(rng.normal(size=(150, 32)), 10, axis=0) + rng.normal(size=(1500, 32)) * 0.05
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    layers = hnsw.built(v.astype(np.float32), np.arange(1500))
    assert [len(m) for m, _ in layers] == sorted(len(m) for m, _ in layers) and len(layers[-1][0]) == 1500
    row = {"nodes": np.arange(1500).tobytes(), "counts": np.ones(1500, np.int64).tobytes(), "vectors": v.tobytes(), "layers": hnsw.Graph.packed(layers)}
    graph = hnsw.Graph(row, 32)
    beam = graph.audited_beam(graph.vectors, 0.98)
    assert len(graph.near(graph.vectors, beam, 0.98)[0]) >= 0.99 * (v @ v.T >= 0.98).sum()


def test_sparse_links_of_a_full_shard_are_found():
    """20 links among nodes that no list leads to; all other nodes find themselves, which is no link."""
    import pyarrow as pa

    rng = np.random.default_rng(11)
    lost = np.concatenate([np.arange(1, 321, 16), np.arange(2, 322, 16)])  # none among each 16th node

    def shard(number, v):
        v = v / np.linalg.norm(v, axis=1, keepdims=True)
        layers = hnsw.built(v.astype(np.float32), np.arange(4096))
        for _, links in layers:
            links[np.isin(links, lost)] = 4096
        nodes = np.arange(4096) + 4096 * number
        row = {"shard": number, "nodes": nodes.tobytes(), "counts": np.ones(4096, np.int64).tobytes()}
        return row | {"vectors": v.tobytes(), "layers": hnsw.Graph.packed(layers)}

    v, w = rng.normal(size=(2, 4096, 32))
    v[lost[20:]] = v[lost[:20]] + rng.normal(size=(20, 32)) * 0.05
    w[lost[:20]] = v[lost[:20]] + rng.normal(size=(20, 32)) * 0.05
    one, two = shard(0, v), shard(1, w)
    for other, want in ((one, 20), (two, 40)):  # a shard with itself, and two shards
        ends = [row | {"low": 0, "high": other["shard"]} for row in ([one] if other is one else [other, one])]
        found = hnsw.search_rows(0.98)((pa.scalar(0), pa.scalar(32)), pa.Table.from_pylist(ends))
        assert sum(found["links"].to_pylist()) == 2 * want


def test_spent_tables_are_removed(spark):
    import os

    table = stored(spark.range(5), "spent")
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder)
    discard(table)
    assert not os.path.exists(folder)


def test_long_lists_are_matched_as_short_ones_are(monkeypatch):
    """The best matching, whatever the number of cells: long lists only take another way to it."""
    rnd = np.random.default_rng(5)
    kinds = ["<p>x</p>", "<div><b>x</b><i>y</i></div>", "<div><i>y</i><b>x</b></div>", "<div><b>x</b></div>", "<ul><li>1<li>2</ul>", "<div></div>"]
    for n, m in [(1, 7), (9, 4), (40, 55), (60, 31)]:
        page, other = (page_text.parse("<body>" + "".join(kinds[k] for k in rnd.integers(0, len(kinds), size)) + "</body>") for size in (n, m))
        found = []
        for cells in (10**9, 0):
            monkeypatch.setattr(page_text, "CELLS", cells)
            matcher = page_text.Matcher()
            found.append(matcher.align(page, matcher.shaped(page), other, matcher.shaped(other)))
        assert found[0] == found[1] and len(found[0]) > 2


def test_wrapper_of_long_and_of_deep_pages(spark):
    """More than 500 x 500 children that differ, and more than 200 levels: template is found as on small pages."""
    rows = []
    for i in range(6):
        lead = "<b>0</b>" + "<i>1</i>" * (60 + i)  # matches nothing in first-fit order beyond 50 places
        marks = "".join(f"<em>{words(2, 1000 * i + k)}</em>" if k % 2 else "<u>same</u>" for k in range(600))
        rows.append((i, f"http://long.org/{i}", f"<body>{lead if i % 2 else ''}{marks}<s>{words(3, 90 + i)}</s></body>"))
        deep = "<div>" * 300 + f"Frame<div>{words(9, i)}</div>"
        rows.append((10 + i, f"http://deep.org/{i}", f"<body>{deep}</body>"))
    got = texts(spark, rows)
    for i in range(6):
        assert "same" not in got[i] and words(3, 90 + i) in got[i]
        assert got[10 + i] == words(9, i)


def test_main_texts_of_a_batch_are_signed_together(monkeypatch):
    pages = [f"<body><p>{words(40, 300 + i)}</p><p>{words(9, 5)}</p></body>" for i in range(30)]
    batch = pa.RecordBatch.from_pydict({"host": ["h"] * 30, "html": pages, "reference": [pages[0]] * 30})
    calls, blocks = [], page_text.words.blocks
    monkeypatch.setattr(page_text.words, "blocks", lambda *a, **k: (calls.append(1), blocks(*a, **k))[1])
    (out,) = page_text.slot_rows(iter([batch]))
    signed = [r for r in out.to_pylist() if r["slot"] is None]
    assert len(calls) == 1 and len({r["variant"] for r in signed}) == 30
    for row, html in zip(signed, pages):
        text = page_text.main_text(page_text.parse(html), set())
        (block,) = blocks(pa.array([text]), page_text.words.LETTERS, lower=True)
        pairs = page_text.words.shingle_set(block.hashes, 2)
        low = page_text.words.mix(pairs[:, None] ^ page_text._SEEDS).min(axis=0) & np.uint64(0x7FFFFFFF)
        assert row["signature"] == low.tolist() and row["variant"] == page_text.digest(text)
