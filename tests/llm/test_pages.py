"""Main text of pages with every kind of clutter."""

import random

from millrace.llm import pages

ARTICLE = ("<article><h1>Title &amp; more</h1><p>First   <b>bold</b>\n text<br>goes on.</p><p>Second &#233; &lt;tag&gt;</p>"
           "<div class='comments'><p>reader says hi</p></div><ul><li>one<li>two</ul></article>")
PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{x:1}</style><script>var a='<p>no</p>';</script></head><body><header>Top</header>"
        "<nav><ul><li><a href='/'>Home</a></ul></nav><!-- c --><div class=\"ad\">Buy<p>now</p></div><div id='cookie-notice'>ok?</div>"
        f"<main>{ARTICLE}</main><aside>side</aside><form><p>mail</p><input></form><footer>&copy; host</footer></body></html>")
WANT = "Title & more\n\nFirst bold text goes on.\n\nSecond é <tag>\n\none\n\ntwo"


def run(spark, rows):
    out = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, main_text int, style_host int"))
    assert out.columns.count("main_text") == 1 and "style_host" in out.columns
    return sorted(((r.page_id, r.main_text) for r in out.collect()), key=str)


def test_article_without_clutter(spark):
    assert run(spark, [(1, "http://h/x", PAGE, 0, 0)]) == [(1, WANT)]


def test_defined_cases(spark):
    cut = "<article><p><b>open bold<p>next"
    rows = [(1, None, None), (2, "", ""), (3, "x", "plain text only"), (4, "http://a/", cut), (5, "http://a/", "<![if x]><p>a</p><!x <p>b"),
            (6, "http://a/", "<p>" + "long " * 50_000 + "</p>"), (7, "http://a/", "<div>" * 3000 + "deep"), (7, "http://a/", "<div>" * 3000 + "deep"),
            (8, "http://a/", "<script>never ends <p>x")]
    got = run(spark, [(*r, 0, 0) for r in rows])
    assert (1, "") in got and (2, "") in got and (3, "plain text only") in got and (4, "open bold\n\nnext") in got
    assert got.count((7, "deep")) == 2 and (8, "") in got
    assert [t for i, t in got if i == 6] == [("long " * 50_000).strip()]
    assert run(spark, []) == []


def test_style_tree_drops_what_a_host_repeats(spark, monkeypatch):
    def page(i):
        return (f"<html><body><div class='box'><p>Welcome to our site</p></div><div class='story'><p>Story number {i} about thing {i * 7}</p></div>"
                "<div class='box2'>All rights belong to us</div></body></html>")

    rows = [(i, "http://one.host/%d" % i, page(i), 0, 0) for i in range(20)] + [(100, "http://two.host/", page(100), 0, 0)]
    got = dict(run(spark, rows))
    assert got[3] == "Story number 3 about thing 21"
    assert got[100].startswith("Welcome")  # one page says nothing about its host
    monkeypatch.setattr(pages, "BROADCAST_NODES", 0)
    assert dict(run(spark, rows)) == got


def test_importance_is_normalised_entropy(spark):
    rows = [(i, "http://h/", f"<p>same</p><div>{i}</div>") for i in range(10)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    content = {round(r.content, 6) for r in pages.importance(df).collect() if r.content is not None}
    assert content == {0.0, 1.0}


def test_class_words_count_as_whole_tokens(spark):
    body = "<article><header class='entry-header'><h1>Title</h1></header><div class='post social-issues'><p>Body.</p></div><div class='comments'>no</div></article>"
    wrapped = ["<div class='layout has-sidebar'>%s</div>", "<div id='content' class='content no-sidebar'>%s</div>", "<div class='header'>%s</div>",
               "<div class='site-header'>top</div><div class='sidebar'>%s</div>"]
    rows = [(i, "http://h/", w % body, 0, 0) for i, w in enumerate(wrapped)]
    rows += [(10, "http://h/", "<header class='entry-header'><h1>Title</h1></header><div class='no-ads legal-history'><p>Body.</p></div><div class='main-menu'>no</div>", 0, 0),
             (11, "http://h/", f"{body}<div id='comments'><article>I disagree</article></div>", 0, 0)]
    assert {t for _, t in run(spark, rows)} == {"Title\n\nBody."}


def made_page(rng, site):
    """A tree ``(tag, texts and trees)`` of a page: parts of its site, parts of its own, texts from few or many."""
    def text():
        return rng.choice(["Home", "About", "All rights", f"site {site}"]) if rng.random() < 0.6 else f"text {rng.random()}"

    def tree(depth):
        inner = [tree(depth - 1) for _ in range(rng.randint(1, 3))] if depth and rng.random() < 0.7 else []
        return rng.choice(["div", "section", "div class='x'", "div class='y'"]), [text(), *inner] if not inner or rng.random() < 0.3 else inner

    menu = ("div class='m'", [("div class='l'", [t]) for t in rng.sample(["Home", "About", "Help", "News", "Jobs"], 3)])
    return "html", [("body", [menu, *(tree(3) for _ in range(rng.randint(1, 3))), ("div class='end'", [f"site {site}"])])]


def written(tree):
    tag, inner = tree
    return f"<{tag}>" + "".join(x if isinstance(x, str) else written(x) for x in inner) + f"</{tag.split()[0]}>"


def plain_style_tree(sites):
    """The texts of ``sites {host: pages}`` by definition: dictionaries of all pages, recursion, no hashes."""
    from collections import Counter, defaultdict
    from math import log

    def walk(tree, path=()):
        path = (*path, tree[0])
        yield path, [x for x in tree[1] if isinstance(x, str)], [x[0] for x in tree[1] if not isinstance(x, str)]
        for x in tree[1]:
            if not isinstance(x, str):
                yield from walk(x, path)

    def entropies(groups):
        shown, texts, places = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter)), defaultdict(set)
        for place, trees in groups.items():
            seen = defaultdict(set)
            for t in trees:
                arranged = defaultdict(list)
                for path, own, children in walk(t):
                    arranged[path].append(tuple(children))
                    for x in own:
                        texts[path][x][place] += 1
                for path, a in arranged.items():
                    seen[path].add(tuple(a))
            for path, looks in seen.items():
                shown[path].update(looks)
                places[path].add(place)

        def spread(counter):
            total = sum(counter.values())
            return -sum(n / total * log(n / total) for n in counter.values())

        out = {}
        for path, looks in shown.items():
            m, all_texts = len(places[path]), sum(sum(c.values()) for c in texts[path].values())
            arrangement = min(1, spread(looks) / log(m)) if m > 1 else 1
            content = (max(0, 1 - sum(spread(c) * sum(c.values()) for c in texts[path].values()) / all_texts / log(m)) if m > 1 else 1) if all_texts else None
            out[path] = m, arrangement, content
        return out

    own = {host: entropies({i: [t] for i, t in enumerate(trees)}) for host, trees in sites.items()}
    every = entropies(sites)
    result = []
    for host, trees in sites.items():
        def value(path, which):
            m, mine = own[host][path][0], own[host][path][which]
            hosts, others = every[path][0], every[path][which]
            first = 1 if mine is None else mine
            return (pages.PRIOR + (m - 1) * first + (hosts - 1) * (first if others is None else others)) / (pages.PRIOR + m + hosts - 2)

        def branch(tree, path=()):
            path = (*path, tree[0])
            inner = [v for v in (branch(x, path) for x in tree[1] if not isinstance(x, str)) if v is not None]
            children = any(not isinstance(x, str) for x in tree[1])
            if any(isinstance(x, str) for x in tree[1]):
                inner.append(value(path, 2))
            if not inner:
                return None
            share = pages.GAMMA ** len(inner) if children else 1
            return (1 - share) * value(path, 1) + share * sum(inner) / len(inner)

        def kept(tree, path=(), above=()):
            me = (*path, tree[0])
            for x in tree[1]:
                if isinstance(x, str):
                    line = [*above, value(me, 2)]
                    if sum(line) / len(line) >= pages.LEAST:
                        yield x
                else:
                    yield from kept(x, me, above if tree[0] in ("html", "body") else (*above, branch(tree, path)))

        result += ["\n\n".join(kept(t)) for t in trees]
    return result


def test_equals_a_plain_style_tree(spark, monkeypatch):
    rng = random.Random(5)
    sites = {f"h{k}": [made_page(rng, k) for _ in range(n)] for k, n in enumerate([1, 2, 5, 12, 40])}
    # pages with the same texts would count once
    assert all(len({pages.parsed(written(t)).copy_key() for t in trees}) == len(trees) for trees in sites.values())
    want = plain_style_tree(sites)
    rows = [(i, f"http://{host}/", html, 0, 0) for i, (host, html) in enumerate((h, written(t)) for h, trees in sites.items() for t in trees)]
    everything = [pages.parsed(r[2]).main_text({}, False) for r in rows]
    assert sum(a != b for a, b in zip(want, everything, strict=True)) > 30  # the tree takes something from most pages
    assert run(spark, rows) == sorted(enumerate(want), key=str)
    monkeypatch.setattr(pages, "HOST_NODES", 0)
    assert run(spark, rows) == sorted(enumerate(want), key=str)


def test_the_tree_alone_finds_menus_of_the_given_pages(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html")
    tree = {r.page_id: r.main_text for r in pages.extract(given, names=False).select("page_id", "main_text").collect()}
    full = {r.page_id: r.main_text for r in pages.extract(given).select("page_id", "main_text").collect()}
    plain = {r.page_id: pages.parsed(r.html).main_text({}, False) for r in given.collect()}
    assert any(tree[i] != plain[i] for i in tree) and all(full[i] in tree[i] for i in tree)


def test_what_a_host_repeats_goes_from_its_articles_too(spark):
    def page(i):
        return f"<article><h1>About {i}</h1><p>Body number {i} with words {i * 3}</p><div class='tail'>Follow us</div></article>"
    got = dict(run(spark, [(i, "http://one.host/%d" % i, page(i), 0, 0) for i in range(40)]))
    assert got[7] == "About 7\n\nBody number 7 with words 21"


def test_copies_count_once(spark):
    body = "<article><h1>One title</h1><p>" + "The same long article on many pages of one host. " * 4 + "</p><p>And its end %d</p></article>"
    rows = [(i, f"http://one.host/{i}", body % (i % 3), 0, 0) for i in range(60)]
    rows += [(100 + i, f"http://host{i}.net/", body.replace("article>", "div>") % i, 0, 0) for i in range(60)]
    got = run(spark, rows)
    assert all(t.startswith("One title\n\nThe same") and "And its end" in t for _, t in got) and len(got) == 120


def test_deep_nesting_takes_memory_in_proportion():
    import tracemalloc
    html = "<div>" * 100_000 + "deep"
    tracemalloc.start()
    page = pages.parsed(html)
    assert page.main_text({n: (0.5, 0.5) for n in page.nodes[:3]}, True) == "deep" and len(page.looks()) == 100_001
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
