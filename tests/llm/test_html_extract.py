"""Main text of pages: structure, page differencing, and defined results."""

import random

from importlens.llm import html_extract as he

SCHEMA = "page_id long, url string, html string, text string, row string"


def lcs(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[-1]))
        rows.append(row)
    return rows[-1][-1]


def test_longest_common_subsequence(monkeypatch):
    rng = random.Random(3)
    for limit in (1 << 28, 4):          # whole, and split in halves
        monkeypatch.setattr(he, "ROWS_LIMIT", limit)
        for _ in range(300):
            a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
            found = sorted(he.common(a, b))
            rest = iter(b)
            assert len(found) == lcs(a, b)
            assert all(a[i] in rest for i in found)


def page(body, title="t"):
    return (f"<html><head><title>{title}</title><style>x{{}}</style></head><body><div>Site of all</div><nav><a href=/>Home</a></nav>"
            f"{body}<div>Imprint and contact</div><script>var a = '<p>no</p>';</script></body></html>")


def test_shared_lines_go_and_own_lines_stay(spark):
    rows = [(i, f"http://h.org/news/{i}.html", page(f"<p>Own &amp; first  {i}</p><p>Second\n of {i}</p>"), "x", "y") for i in range(6)]
    got = {r.page_id: r.text for r in he.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Own & first {i}\n\nSecond of {i}" for i in range(6)}


def test_article_without_its_surroundings(spark):
    body = ("<header><h1>Banner</h1></header><article><h1>Head</h1><p>One<br>two &eacute;</p><aside>More</aside><ul><li>a<li>b</ul>"
            "<form>f</form></article><section class=comments><p>Nice</p></section><footer>Foot</footer>")
    rows = [(1, "http://x/a", page(body), None, None), (2, None, page(body), None, None)]
    got = {r.page_id: r.text for r in he.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "Head\n\nOne two é\n\na\n\nb", 2: "Head\n\nOne two é\n\na\n\nb"}


def test_defined_results(spark):
    long = "<article>" + "".join(f"<p>Paragraph {i} stands here.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "http://x/1", None, "a", "b"), (2, "http://x/2", "", "a", "b"), (3, None, "<p>plain", "a", "b"),
            (None, "http://x/4", "<article><p>no id</article>", "a", "b"), (5, "http://x/5", long, "a", "b"),
            (6, "", "<b", "a", "b"), (3, None, "<p>plain", "a", "b")]
    got = he.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r.text for r in got}
    assert (by_id[1], by_id[2], by_id[3], by_id[None], by_id[6]) == ("", "", "plain", "no id", "")
    assert by_id[5].count("\n\n") == 19_999 and by_id[5].endswith("Paragraph 19999 stands here.")
    assert he.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_partners_are_near(spark):
    rows = [(i, "h", p) for i, p in enumerate(["/a/1", "/a/2", "/a/3", "/b/x/1", "/b/x/2", "/b/y", "/c"])] + [(90, "g", "/a/1"), (91, "", "/a")]
    got = {}
    for r in he.partners(spark.createDataFrame(rows, "row long, host string, path string")).collect():
        got.setdefault(r.row, set()).add(r.partner)
    assert got[1] == {0, 2} and got[3] == {4} and got[4] == {3}
    assert 90 not in got and 91 not in got
    assert all(0 < len(p) <= 2 for p in got.values()) and set(got) == set(range(7))


def one(body, partners=()):
    lines = he.page_lines(body)
    return he.main_text(lines, he._keys(lines), [he._keys(he.page_lines(p)) for p in partners])


def test_class_names_count_whole():
    body = ('<article><div class="market-share"><p>Half of it.</p></div><p class="related-work">Others did too.</p>'
            '<div class="share-buttons ad-slot-2"><p>Tell</p></div><div class="cookie-banner">ok?</div></article>')
    assert one(body) == "Half of it.\n\nOthers did too."
    assert one('<div id="social-history"><p>Long ago.</p></div><div class="site-footer">x</div>') == "Long ago."


def test_inline_adverts_controls_and_formulas():
    body = ('<article><p>One <span class="advert">Buy <b>now</b></span>two <button>Share</button><math><mi>x</mi></math> three.</p>'
            '<p>Four <label>Name</label><select><option>a</select>five</p></article>')
    assert one(body) == "One two x three.\n\nFour five"


def test_body_beside_a_teaser_article():
    body = "<div><p>" + "The body of the page stands here. " * 5 + "</p></div><article><p>Read this next</p></article><nav>Menu</nav>"
    assert one(body).startswith("The body of the page") and "Menu" not in one(body)
    other = "<div><p>Imprint and contact of the house.</p></div><article><p>" + "Its own text. " * 20 + "</p></article>"
    assert one(other) == ("Its own text. " * 20).strip()


def test_lines_that_articles_share_stay():
    pages = [f"<article><p>Of page {i} alone.</p><p>A sentence in all of them.</p></article>" for i in range(3)]
    assert one(pages[0], pages[1:]) == "Of page 0 alone.\n\nA sentence in all of them."


def brute_partners(rows):
    """First and last path of the longest common start that holds another path of the host."""
    out = {}
    for row, host, path in rows:
        if not host:
            continue
        starts = {path[:len(path) - n] for n in (1, 2, 3) if n <= len(path.rsplit("/", 1)[-1])}
        starts |= {"/".join(path.split("/")[:n]) + "/" for n in range(1, path.count("/") + 1)} | {""}

        def has(p, start):
            own = {p[:len(p) - n] for n in (1, 2, 3) if n <= len(p.rsplit("/", 1)[-1])}
            return start in own | {"/".join(p.split("/")[:n]) + "/" for n in range(1, p.count("/") + 1)} | {""}
        for start in sorted(starts, key=len, reverse=True):
            group = sorted((p, r) for r, h, p in rows if h == host and has(p, start))
            if group[0][0] != group[-1][0]:
                out[row] = {r for p, r in (group[0], group[-1]) if p != path}
                break
    return out


def test_whole_query_against_all_pairs(spark):
    """Pages without article tags: partners, alignment and deletion as a plain rerun finds them."""
    rng = random.Random(9)
    rows = []
    for i in range(60):
        host = rng.choice(["a.org", "b.org"])
        path = rng.choice(["/n/", "/n/x/", "/"]) + str(rng.randrange(10, 400))
        template = [f"<div>Top of {host}</div>", "<ul><li><a href=/>Home</a><li><a href=/b>All</a></ul>", f"<div>Imprint {host} {path[:3]}</div>"]
        body = "".join(f"<p>Sentence {rng.randrange(40)} of it.</p>" for _ in range(rng.randrange(1, 6)))
        rows.append((i, f"http://{host}{path}?x={i}", "<body>" + template[0] + template[1] + body + template[2], None, None))
    got = {r.page_id: r.text for r in he.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    ids = {r.row: r.page_id for r in df.select(he._row_id(df).alias("row"), "page_id").collect()}
    by_id = {v: k for k, v in ids.items()}
    places = [(by_id[i], u.split("/")[2], "/" + u.split("/", 3)[3].split("?")[0]) for i, u, *_ in rows]
    near, pages = brute_partners(places), {r[0]: r[2] for r in rows}
    changed = 0
    for i, page_text in pages.items():
        others = [pages[ids[r]] for r in near.get(by_id[i], ())]
        want = one(page_text, others)
        changed += want != one(page_text)
        assert got[i] == want, (i, others)
    assert changed > 50                  # differencing decides on pages without clean tags
