"""Each operator against a brute-force version on small rows, with the edge cases that its docstring defines."""

import base64
import hashlib
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazetta.llm import bpe, decontam, exact_dedup, html_extract, langid, minhash, pii, sharding, suffix_dedup, warc
from gazetta.llm.suffix_array import suffix_array

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, digest string, shard int"


def rows_of(df, *columns):
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    """Real rows, with nulls, empty and long texts, repeats, ties and columns whose names clash with our own."""
    real = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = [(10_001, None, "en"), (10_002, "", None), (10_003, real[3][1], "en"), (10_003, real[3][1], "en"), (None, real[3][1], None), (10_004, "a \t\n b", "en"), (10_005, "a b", "en"), (10_006, "word " * 30_000, "en"), (10_007, "ß" * 5_000, "de")]
    return spark.createDataFrame([(*x, "d", 1) for x in real + odd], DOCS).repartition(3)


@pytest.fixture(scope="module")
def local(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def test_suffix_dedup(docs, local, nothing, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 40_000)  # many blocks
    big = 1 << 62
    seen: dict[bytes, int] = {}
    for i, t in local:
        b, i = (t or "").encode(), big if i is None else i
        for k in range(len(b) - 49):
            seen[b[k : k + 50]] = min(i, seen.get(b[k : k + 50], big))
    want = []
    for i, t in local:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < (big if i is None else i):
                gone[k : k + 50] = b"\1" * 50
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((i, len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(left).hexdigest()))
    assert rows_of(suffix_dedup.remove_repeats(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_long_documents_are_cut_alike(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 100)
    text = bytes(range(33, 120)) * 9
    a, b = (suffix_dedup.every_piece(*suffix_dedup.laid_out(x)) for x in ([text, b"x" * 30], [b"y" * 64, text]))
    assert sorted(a[4][a[0] == 0]) == sorted(b[4][b[0] == 1])
    covered = sum(int(z - s) - 49 for s, z in zip(a[1], a[2], strict=True))
    assert covered == len(text) - 49  # each window once


def test_suffix_array_sorts():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(60):
        s = np.concatenate((rng.integers(1, rng.integers(2, 6), rng.integers(1, 80)), [0])).astype(np.uint16)
        b = s.astype(">u2").tobytes()
        assert suffix_array(s, 200).tolist() == sorted(range(len(s)), key=lambda i: b[2 * i :])


def test_exact_dedup(docs, local, nothing):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in local]
    groups: dict[str, list] = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    keep = {t: min([i for i in v if i is not None], default=None) for t, v in groups.items()}
    want = [(i, keep[t], len(groups[t]), i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm]
    assert rows_of(exact_dedup.exact_groups(docs, fan_in=2), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_groups(nothing).count() == 0
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert rows_of(left, "doc_id") == sorted([(w[0],) for w in want if w[3]], key=repr)


def test_merge_verifies_lengths():
    import numpy as np

    a = np.zeros(2, exact_dedup.ENTRY)
    a["digest"], a["size"] = b"x" * 32, [1, 2]
    with pytest.raises(ValueError, match="share a digest"):
        exact_dedup.merge_entries([a])


PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def base_spans(t):
    def luhn(d):
        return sum(c if k % 2 == 0 else c * 2 - 9 * (c > 4) for k, c in enumerate(map(int, reversed(d)))) % 10 == 0

    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if [True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_pii_spans(spark, docs, local, nothing):
    import random

    rng = random.Random(7)
    bits = ["1", "25", ".", "-", " ", "+", "@", "a", "é", "😀", "(", ")", "_", "\x01", "\n", "4111 1111 1111 1111", "+1 (988) 555-2485", "x@y.zz", "1.2.3.4"]
    fuzz = [(i, "".join(rng.choice(bits) for _ in range(rng.choice([4, 25, 90])))) for i in range(20_000, 20_600)]
    fuzz += [(30_000, "a@" + "b." * 2_000 + "c"), (30_001, "1 " * 3_000), (30_002, "+" * 500 + "1" * 20)]
    every = docs.select("doc_id", "text").unionByName(spark.createDataFrame(fuzz, "doc_id long, text string"))
    told = [(i, base_spans(t or "")) for i, t in local + fuzz]
    want = [(i, hashlib.sha256(x.encode()).hexdigest(), *(x.count(f"{k}:") for k in ("email", "ip", "card", "phone"))) for i, x in told]
    assert rows_of(pii.digest(pii.find_personal_data(every)), "doc_id", "base_sha256", "n_email", "n_ip", "n_card", "n_phone") == sorted(want, key=repr)
    assert pii.digest(pii.find_personal_data(nothing)).count() == 0


def test_pii_terms_that_disclose(spark):
    near = [(1, "Contact Zygmunt here: zy@mail.org please"), (2, "write to Zygmunt at zy@mail.org now"), (3, "please write now here"), (4, "contact me please")]
    noise = [(i, f"nothing about it please contact number{i}") for i in range(10, 60)]
    df = spark.createDataFrame(near + noise, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digest(pii.find_personal_data(df)).collect()}
    assert "term:8:15" in got[1].spans and "term:9:16" in got[2].spans
    assert all(not got[i].spans for i, _ in near[2:] + noise)
    texts = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    assert "zy@" not in texts[1] and "Zygmunt" not in texts[1] and "[email]" in texts[1] and texts[4] == "contact me please"


def test_pii_terms_of_an_entity_seen_once(spark):
    """An entity in one text is judged like others, and copies count once."""
    rare = [(1, "Contact Zygmunt here: zy@mail.org please")]
    copied = [(i, "Contact Wanda here: wa@mail.org please") for i in range(2, 8)] + [(8, "Contact about wa@mail.org please")]
    noise = [(i, f"nothing about it here please contact number{i}") for i in range(10, 60)]
    df = spark.createDataFrame(rare + copied + noise, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(df)).collect()}
    assert got[1] == "term:8:15,email:22:33"
    # wa@mail.org is in 2 of 53 texts, Wanda in one: PMI = IC. Copies are judged like their first.
    assert all(got[i] == "term:8:13,email:20:31" for i, _ in copied[:-1]) and got[8] == "email:14:25"


def test_pii_terms_of_the_whole_document(spark):
    """A name far from the entity, one of two letters, and each of its places."""
    import math
    import random

    rng = random.Random(6)
    fill = " ".join(["please"] * 40)
    rows = [(1, f"Lee wrote. {fill} Lee: lee.x@mail.org {fill} 李明 Lee")] + [(i, f"please write to number{i}") for i in range(2, 40)]
    rows += [(i, " ".join(rng.choice(["a", "bo", "Cid", "x@y.zz", "X@Y.zz", "1.2.3.4", "x4111111111111111", "É1", "7"]) for _ in range(rng.choice([3, 9, 300])))) for i in range(100, 140)]
    spans = {i: [(int(s), int(e)) for x in base_spans(t).split(",") if x for s, e in [x.split(":")[1:]]] for i, t in rows}
    words = {i: [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W_]+", "".join(" " if any(s <= k < e for s, e in spans[i]) else c for k, c in enumerate(t)))] for i, t in rows}
    texts = {t: i for i, t in rows}
    shown = {i: {x.split(":")[0] + ":" + t[int(x.split(":")[1]) : int(x.split(":")[2])].lower() for x in base_spans(t).split(",") if x} for t, i in texts.items()}
    every = {i: {w.lower() for w in re.findall(r"[^\W_]+", t)} for t, i in texts.items()}
    want = {}
    for i, t in rows:
        flagged = []
        for s, e, w in words[i] if spans[i] else []:
            n_t = sum(w in x for x in every.values())
            shares = []
            for p in shown[texts[t]]:
                n_e = sum(p in x for x in shown.values())
                n_et = sum(p in shown[j] and any(w == x[2] for x in words[j]) for j in texts.values())
                shares.append(math.log2(n_et * len(texts) / (n_e * max(n_t, n_et))) / math.log2(len(texts) / n_e))
            if re.search(r"[^\W\d_]", w) and max(shares) >= pii.DISCLOSURE:
                flagged.append(f"term:{s}:{e}")
        want[i] = flagged
    got = {r.doc_id: [x for x in r.spans.split(",") if x.startswith("term")] for r in pii.digest(pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == want and len(got[1]) == 5  # wrote, Lee three times, and two characters


def test_sharding(spark, docs, local, nothing):
    got = sharding.shard_plan(docs).collect()
    size = {(i, t): len((t or "").encode()) + 1 for i, t in local}
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(((i, size[i, t], zlib.crc32((t or "").encode())) for i, t in local), key=repr)
    for r in got:
        u = lambda s: int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{s}".encode()).hexdigest()[:13], 16)  # noqa: B023, E731
        assert r.shard == max(range(8), key=u) and r.grown_shard == max(range(9), key=u) and r.grown_shard in (r.shard, 8)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_plan(nothing).count() == 0
    keys = spark.range(20_000).withColumn("shard", F.lit("clash"))
    n = {r.s: r["count"] for r in sharding.shard_records(keys, [1.0, 3.0, 0.0], "id", "s").groupBy("s").count().collect()}
    assert set(n) == {0, 1} and 0.72 < n[1] / 20_000 < 0.78
    clash = sharding.shard_records(keys.limit(3).withColumn("Shard_1", F.lit("too")), [1.0], "id")
    assert clash.columns == ["id", "shard", "Shard_1", "shard_2"] and [tuple(r)[1:] for r in clash.collect()] == [("clash", "too", 0)] * 3


def test_language_id(spark, docs, nothing):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(big.where(~langid.held_out()))
    got = langid.identify(big, model).where(langid.held_out()).where(F.length("text") > 60).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    odd = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert (odd[10_001].lang_pred, odd[10_002].lang_pred, odd[10_001].score) == ("und", "und", 0.0)
    short = langid.identify(big, model).where(langid.held_out() & (F.length("text") <= 60) & F.col("lang").isNotNull()).collect()
    assert sum(r.lang == r.lang_pred for r in short) >= 0.5 * len(short)
    clash = docs.withColumns({"score": F.lit("s"), "lang_pred": F.lit("p"), "row": F.lit("r"), "_text": F.lit("t")})
    kept = langid.keep_identified(clash, model)
    assert kept.columns == clash.columns and {(r.score, r.lang_pred, r.row, r._text) for r in kept.collect()} == {("s", "p", "r", "t")}
    assert rows_of(kept, "doc_id") == rows_of(langid.identify(docs, model).where(langid.accepted()), "doc_id")
    assert "score" in langid.identify(clash, model).columns
    digits = spark.createDataFrame([(1, "12 ²³ !?")], "doc_id long, text string")
    assert langid.identify(digits, model).first().lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in odd.values())
    assert langid.identify(nothing, model).count() == 0 and langid.train(nothing) == {}
    assert langid.identify(digits, {}).where(langid.accepted()).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("<nav>menu</nav><article><h1>T &amp; x</h1><p><b>One\n two<br><p>three<script>var a='</p>'</script><aside>no</aside></article><footer>no</footer>", "T & x\nOne two\nthree"),
        ("<article><p>short</p><div class='ad'>buy</div><form><p>no</p></form><p>a much longer paragraph of text that counts</p><section id='comments'><p>hi</p></section></article>", "short\na much longer paragraph of text that counts"),
        ("plain text &lt;only", "plain text <only"),
        ('<div class="layout with-sidebar"><nav><a href="/">home</a></nav><article class="has-sidebar"><h1>T</h1><p>A long enough paragraph of text, it goes on.</p></article><div class="sidebar">side</div></div>', "T\nA long enough paragraph of text, it goes on."),
        ("<main><p>A lead before.</p><article><p>" + "long text " * 40 + "</p></article></main>", "A lead before.\n" + "long text " * 39 + "long text"),
        ("<article><p>" + "long text " * 40 + "</p></article><section id='comments'><article class='comment'><p>" + "nice post " * 20 + "</p></article></section>", "long text " * 39 + "long text"),
        ("<div class='footer'><p>all of it is marked, so marks say nothing</p></div>", "all of it is marked, so marks say nothing"),
    ],
)
def test_html(html, text):
    assert html_extract.main_text(html) == text


TEASERS = "<article><h1>T</h1><p>" + "Words that make an article. " * 9 + "</p><p>A short one.</p></article>" + "<article><a href='/x'>Read more of this</a></article>" * 5


def test_html_scores_choose_the_content(monkeypatch):
    """Teasers are articles without a mark: only their scores tell them from the article."""
    want = "T\n" + ("Words that make an article. " * 9).strip() + "\nA short one."
    assert html_extract.main_text(TEASERS) == want
    monkeypatch.setattr(html_extract, "line_scores", lambda page: [1.0] * len(page.lines))
    assert html_extract.main_text(TEASERS) != want


LONG = "A paragraph of the article goes on for a while, with words enough to be told from a menu. " * 3
PAGES = [
    # no article element: headings, and a long tail of short paragraphs
    ("<nav><a href='/'>home</a><a href='/b'>b</a></nav><div class='ad'>buy this now</div><div id='text'><h1>T</h1><p>" + LONG + "</p>" + "".join(f"<p>end {i}</p>" for i in range(6)) + "</div><div class='footer'>contact us</div>", ["T", LONG.strip(), *(f"end {i}" for i in range(6))]),
    ("<body><nav><a href='/'>home</a></nav><p>" + LONG + "</p><p>and then</p><p>the end</p><footer>legal text here</footer></body>", [LONG.strip(), "and then", "the end"]),
    # names of headings and sections, and names that only hold a marked word
    ("<nav><a>x</a></nav><article><h2 id='related-work'>Related</h2><section id='navigation'><p>short</p><p>" + LONG + "</p></section><div class='social-science'><p>s</p></div><p class='banner-quote'>q</p><ul class='menu-of-dishes'><li>soup</li></ul><section class='notice-board'><p>b</p></section></article>", ["Related", "short", LONG.strip(), "s", "q", "soup", "b"]),
    # a second, short article
    ("<header>Site</header><article><h1>One</h1><p>" + LONG * 3 + "</p></article><article><h1>Two</h1><p>A short one.</p></article><aside>see also</aside>", ["One", (LONG * 3).strip(), "Two", "A short one."]),
    # heading and lead in main beside the article
    ("<nav><a>x</a></nav><main><h1>Head</h1><p>The lead.</p><article><p>" + LONG * 3 + "</p></article></main><footer>foot</footer>", ["Head", "The lead.", (LONG * 3).strip()]),
]


@pytest.mark.parametrize(("html", "lines"), PAGES)
def test_html_regions_come_from_scores(html, lines, monkeypatch):
    import random

    assert html_extract.main_text(html) == "\n".join(lines)
    rng = random.Random(1)
    monkeypatch.setattr(html_extract, "line_scores", lambda page: [rng.random() for _ in page.lines])
    assert sum(html_extract.main_text(html) != "\n".join(lines) for _ in range(20)) >= 3


def test_html_marks_alone_delete_nothing():
    """A marked element in an article that scores as the article does stays; one that scores less goes."""
    rich = "<article><p>" + LONG + "</p><div class='widget'><p>" + LONG * 30 + "</p></div></article>"
    assert html_extract.main_text(rich) == f"{LONG.strip()}\n{(LONG * 30).strip()}"
    assert html_extract.main_text("<article><p>" + LONG + "</p><div class='widget'><p>get it</p></div></article>") == LONG.strip()


def test_html_scores_by_hand():
    page = html_extract.Lines()
    page.feed("<nav><a>home</a></nav><article><p>ten <b>chars</b></p><div class='ad'>buy</div></article>")
    page.finish()
    # A tag that ends a line counts to it: nav, a, /a, /nav; article, p, b, /b, /p; div, /div.
    assert [(x.text, x.tags, x.linked, x.region, x.weight) for x in page.lines] == [("home", 4, 4, 0, html_extract.STRUCTURAL), ("ten chars", 5, 0, 1, 1.0), ("buy", 2, 0, 1, html_extract.NAMED)]
    assert html_extract.line_scores(page) == [0.0, 9 / 5, html_extract.NAMED * 3 / 2]
    import math

    w = [math.exp(-d * d / 2) for d in range(3)]
    got = html_extract.smoothed([0.0, 3.0, 0.0])
    assert got == pytest.approx([3 * w[1] / (w[0] + w[1] + w[2]), 3 * w[0] / (w[0] + 2 * w[1]), 3 * w[1] / (w[0] + w[1] + w[2])])
    assert html_extract.threshold([1.0, 2.0, 10.0, 12.0]) == 6.25


def test_html_of_labelled_pages(spark):
    """The article's blocks, cut out by a pattern that knows how these pages are made."""
    import html as standard

    pages = [(r.page_id, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    got = {r.page_id: r.text for r in html_extract.extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    for i, h in pages:
        inner = re.search(r"<article>(.*)</article>", h, re.S)[1]
        blocks = [re.sub(r"\s+", " ", standard.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)>", re.sub(r"(?s)<script>.*?</script>|<!--.*?-->", "", inner))]
        assert got[i] == "\n".join(filter(None, blocks))


def test_html_odd_rows(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    df = spark.createDataFrame([(1, "u", long, "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert sorted((r.page_id or 0, r.n_chars) for r in html_extract.extract_text(df).collect()) == [(0, 0), (1, 1), (1, 1), (1, 999_999)]


def test_html_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = html_extract.extract_text(pages).collect()
    assert len(got) == pages.count() and all(r.n_chars == len(r.text) > 0 for r in got)
    assert html_extract.extract_text(pages.where("false")).count() == 0


def test_warc(spark, tmp_path):
    rows = [(3, "http://b.org/x", "same"), (1, "http://a.org/", "same"), (2, "http://www.a.org/y?z=1#f", "<p>é\r\n\r\nWARC/1.1\r\n"), (5, None, None), (4, "http://c.org", ""), (9, "http://c.org", "same")] + [(i, "http://hot.org/", f"p{i % 7}") for i in range(100, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = warc.archived(pages, str(tmp_path / "w")).collect()
    first: dict[bytes, int] = {}
    for i, _, h in rows:
        first[(h or "").encode()] = min(i, first.get((h or "").encode(), i))
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first[p] == i else "revisit", None if first[p] == i else first[p]))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want)
    index = warc.capture_index(spark, str(tmp_path / "w"), rows_per_part=40).orderBy("part", "rank").collect()
    keys = [(r.url_key, r.timestamp, r.page_id) for r in index]
    assert keys == sorted(keys) and len({r.part for r in index}) > 3
    empty = warc.archived(pages.where("false"), str(tmp_path / "e"))
    assert empty.count() == 0
    # Rows without an id and repeated rows; and one long page, which takes no place from the archives of the others.
    odd = [(None, "http://a.org", "x" * 50), (None, "http://a.org", "x" * 50), (7, "http://a.org", "x" * 50), (7, "http://a.org", "x" * 50), (8, None, "y" * 9_000_000), *((i, "http://b.org", f"z{i}") for i in range(20, 60))]
    got = warc.archived(spark.createDataFrame(odd, "page_id long, url string, html string").coalesce(1), str(tmp_path / "o")).collect()
    told = sorted(((r.page_id, r.record_type, r.refers_to) for r in got if (r.page_id or 0) < 20), key=repr)
    assert told == sorted([(None, "response", None)] * 2 + [(7, "response", None)] * 2 + [(8, "response", None)], key=repr)
    assert len({r.archive for r in got}) == 2 and len(got) == len(odd)


def test_merge_reads_sorted_blocks(monkeypatch):
    """Blocks go through the loser tree as they are, a few captures of each at a time."""
    import pyarrow as pa

    capture = lambda k, a: dict(zip(warc.CAPTURE.names, (f"u{k:03d}", "t", k, 1, "d", "response", None, a, k), strict=True))
    runs = [[capture(k, a) for k in range(i, 900, 3)] for i, a in enumerate("xyz")]
    table = pa.table({"part": pa.array([0] * 3, pa.int32()), "captures": pa.array(runs, warc._BLOCK.field("captures").type)}, schema=warc._BLOCK)
    out = warc._merge((pa.scalar(0),), table)
    assert out.column("page_id").to_pylist() == list(range(900)) == out.column("rank").to_pylist()
    first = warc._block(table.column("captures")[0])
    assert next(first)[1][2] == 0 and next(first)[1][2] == 3


def test_loser_tree():
    import random

    rng = random.Random(2)
    for k in range(9):
        runs = [sorted(rng.randrange(9) for _ in range(rng.randrange(6))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


def brute_components(rows, k, percent):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)), key=repr)


def test_minhash(docs, local, nothing):
    got = minhash.near_duplicates(docs, shingle=2)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_components(local, 2, 80)
    assert minhash.near_duplicates(nothing).count() == 0


def test_minhash_large_group_of_near_copies(spark, monkeypatch):
    """Copies that differ among themselves by about the threshold, in one block and in many, with and without heads."""
    import random

    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for d in range(90):
        w = list(base)
        for _ in range(rng.choice([2, 3])):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    # A near copy without an id; documents linked through one without an id only; rows without words.
    q = [f"q{i}" for i in range(60)]
    rows += [(1000, " ".join(q)), (None, " ".join([*q[:59], "zz"])), (None, None), (7000, ""), (8000, None), (9000, "one")]
    r = [f"r{i}" for i in range(80)]
    rows += [(2000, " ".join(["a"] * 1 + ["b", "c", "d"] + r[4:])), (None, " ".join(r)), (2001, " ".join([*r[:76], "e", "f", "g", "h"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block, heads, outside in ((512, 4, 8), (16, 2, 8), (16, 0, 1)):
        monkeypatch.setattr(minhash, "OUTSIDE", outside)
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "HEADS", heads)
        assert rows_of(minhash.near_duplicates(df, shingle=2), "doc_id", "n_shingles", "component_id") == brute_components(rows, 2, 80)


def template_group(n, shared=70, own=15):
    """Texts of one template with similarity 0.7 or so; the last two of them are near copies of others."""
    rows = [(i, " ".join([f"t{k}" for k in range(shared)] + [f"o{i}x{k}" for k in range(own)])) for i in range(n)]
    return [*rows, (n, rows[0][1] + " z"), (n + 1, rows[n // 2][1] + " y")]


def test_minhash_of_one_template_grows_with_its_members(spark, monkeypatch):
    """No step makes rows faster than the group grows, and the links are found."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "OUTSIDE", 1)
    save, met, made = minhash.Finder.save, minhash.Finder.pairs_of_blocks, {}

    def counted(self, df, label):
        out = save(self, df, label)
        counts[label] = counts.get(label, 0) + out.count()
        return out

    def counted_pairs(rows):
        counts["pairs of blocks"] = counts.get("pairs of blocks", 0) + met(rows).count()
        return met(rows)

    monkeypatch.setattr(minhash.Finder, "save", counted)
    monkeypatch.setattr(minhash.Finder, "pairs_of_blocks", staticmethod(counted_pairs))
    for n in (200, 400):
        counts = made[n] = {}
        rows = template_group(n)
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
        assert got == {i: {n: 0, n + 1: n // 2}.get(i, i) for i, _ in rows}
    assert "rarest" in made[400]
    assert {k: (made[200].get(k, 0), v) for k, v in made[400].items() if v > 2.6 * max(made[200].get(k, 0), 60)} == {}


def test_similar_sets_share_a_rare_member():
    import numpy as np

    rng = np.random.default_rng(6)
    counts = rng.integers(0, 5, minhash.SLOTS)
    for _ in range(2000):
        n = int(rng.integers(1, 40))
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        x, y = (np.unique(np.concatenate((both, rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64)))) for _ in "xy")
        similar = 100 * n >= 80 * (len(x) + len(y) - n)
        x, y = sorted((x, y), key=len)
        (a, few), (b, _) = minhash.rarest(x, counts, 80), minhash.rarest(y, counts, 80)
        assert not similar or len(np.intersect1d(a[:few], b))


def thue_morse(n):
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_long_words_are_told_apart(spark):
    """Words that every polynomial hash modulo 2**64 takes for the same."""
    a, b = thue_morse(10)
    df = spark.createDataFrame([(1, f"x {a}"), (2, f"x {b}"), (3, f"x {a} "), (4, f"{a} y z u v"), (5, f"{b} y z u v")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, shingle=2).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}
    items = spark.createDataFrame([(7, f"{b} y z u v")], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.edits) for r in decontam.contaminated(df, items).orderBy("doc_id").collect()] == [(4, 7, 1), (5, 7, 0)]


def test_minhash_recall_at_the_threshold():
    """Pairs of similarity 0.8 to 0.82 share a band key and pass the sketches, which never rule out a similar pair."""
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (9, 90, 1800):
        for _ in range(150):
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            extra = n // 8
            x, y = (np.unique(np.concatenate((both, rng.integers(0, 1 << 63, extra, dtype=np.uint64)))) for _ in "xy")
            assert 100 * len(both) >= 80 * (n + 2 * extra)
            assert (minhash.band_keys(minhash.signature(x)) == minhash.band_keys(minhash.signature(y))).any()
            a, b, _ = minhash.likely_pairs([minhash.odd_sketch(x), minhash.odd_sketch(y)], np.array([len(x), len(y)]), np.array([True, True]), np.array([0, 1]), 80)
            assert sorted((*a, *b)) == [0, 1]


def test_forests_leave_no_component_behind():
    import numpy as np

    x, y = np.array([0, 0, 1, 3, 2]), np.array([1, 2, 2, 4, 0])
    one = minhash.forests(x, y, np.array([0.1, 0.3, 0.2, 0.9, 0.4]), np.arange(5), 1)
    assert one.tolist() == [0, 2, 3]
    assert sorted(minhash.forests(x, y, np.zeros(5), np.arange(5), 4).tolist()) == [0, 1, 2, 3, 4]


def test_rows_are_dropped_one_by_one(spark):
    """Not by id: a unique text stays whatever its id; of repeated rows one stays; clashing names pass through."""
    rows = [(1, "a"), (None, "a"), (None, "unique"), (2, "b"), (2, "a"), (3, "c"), (3, "c"), (None, None), (5, ""), (None, "d"), (None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(n) for n in ("row", "text_key", "group", "_i", "stays", "id")})
    for drop in (exact_dedup.drop_exact_copies, minhash.drop_near_duplicates):
        left = drop(df)
        assert left.columns == df.columns and all(r.row == "row" and r.stays == "stays" for r in left.collect())
        got = rows_of(left, "doc_id", "text")
        assert [x for x in got if x[1]] == sorted([(1, "a"), (None, "unique"), (2, "b"), (3, "c"), (None, "d")], key=repr)
        assert len([x for x in got if not x[1]]) == (1 if drop is exact_dedup.drop_exact_copies else 2)


def test_components(spark):
    from gazetta.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 103: 100}


@pytest.fixture(scope="module")
def coder():
    from gazetta.llm.queries import tokenizer_file

    return tokenizer_file()


def test_bpe(docs, local, nothing, coder):
    import tiktoken

    data, pattern = coder
    tk = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})
    want = []
    for i, t in local:
        ids = tk.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows_of(bpe.encode_texts(docs, data, pattern), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert bpe.encode_texts(nothing, data, pattern).count() == 0


def test_bpe_of_odd_characters(spark, coder):
    import random

    import tiktoken

    data, pattern = coder
    tk = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})
    encode, _ = bpe.text_encoder(data, pattern)
    rng = random.Random(3)
    for _ in range(1500):
        s = "".join(rng.choice("ab eèß漢字1 9.\x1c\x85 ²Ⅷ_́\r\n\n\t's'llthe😀𝒳") for _ in range(rng.choice([3, 20, 120])))
        assert list(memoryview(encode(s)).cast("I")) == tk.encode_ordinary(s)
    with pytest.raises(ValueError, match="no token"):
        bpe.encode_texts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), b"YQ== 0", pattern)


def test_decontamination(spark, docs, nothing):
    import random

    rng = random.Random(4)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()]
    planted, want = [], set()
    for n in range(60):
        i, t = rng.choice(items)
        w = re.findall(r"[^\W_]+", t)
        for _ in range(rng.randint(0, decontam.allowed(len(w)))):
            p = rng.randrange(len(w))
            w[p : p + 1] = rng.choice([["zq"], [], [w[p], "yy"]])
        planted.append((50_000 + n, clean[n % 30][1][:300] + " " + " ".join(w) + " " + clean[n % 7][1][:200]))
        want.add((50_000 + n, i))
    odd = [(60_000, None), (60_001, ""), (60_002, "word " * 40_000)]
    df = spark.createDataFrame(planted + odd, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*items, (900, None), (901, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert want <= got and not {d for d, _ in got} & {60_000, 60_001, 60_002}
    assert decontam.decontaminate(df, bench).columns == df.columns
    assert {r.doc_id for r in decontam.decontaminate(df, bench).collect()} == {60_000, 60_001, 60_002}
    assert decontam.contaminated(nothing, bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_of_short_items(spark):
    """Each single edit of items of five to seven words, which 20 % allow; two edits, and one of four words, are too many."""
    items = [(n, " ".join(f"item{n}w{k}" for k in range(n))) for n in range(4, 8)]
    near, far = [], []
    for n, t in items:
        for p in range(n):
            for new in ([], ["zq"], [t.split()[p], "zq"]):
                w = t.split()
                w[p : p + 1] = new
                if n == 4 and len(w) > 4 and p == 3:
                    continue  # the item itself, and a word after it
                (near if n > 4 else far).append((n, f"some words before {' '.join(w)} and after"))
        w = t.split()
        w[1], w[3] = "zq", "yy"
        far.append((n, f"some words before {' '.join(w)} and after"))
    rows = [(i, t) for i, (_, t) in enumerate(near + far)]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got, "doc_id", "item_id") == sorted([(i, n) for i, (n, _) in enumerate(near)], key=repr)


def test_bit_sampling_recall():
    """Without the grams: windows with as many edits as are allowed share a key with the item; most others don't."""
    import random

    import numpy as np

    rng = random.Random(8)
    vocabulary = [rng.randrange(1 << 60) for _ in range(2000)]
    for n in (5, 16, 40, 200):
        items, near, far = [], [], []
        for _ in range(200):
            w = rng.choices(vocabulary, k=n)
            items.append(w)
            e = list(w)
            for _ in range(decontam.allowed(n)):
                p = rng.randrange(len(e))
                e[p : p + 1] = rng.choice([[rng.randrange(1 << 60)], [], [e[p], rng.randrange(1 << 60)]])
            near.append((e + rng.choices(vocabulary, k=n))[:n])
            far.append(rng.choices(vocabulary, k=n))
        a, b, c = (decontam.keys(np.array(x, np.uint64)) for x in (items, near, far))
        assert (a == b).any(axis=1).mean() >= 0.9 and (a == c).any(axis=1).mean() <= 0.3


def test_decontamination_by_brute_force(spark):
    """Row by row against the edit distance of every item to every passage, clean rows and repeated rows and items included."""
    import random

    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 5, 9, 16])))) for i in range(25)]
    items += [items[3], (99, None), (98, "...")]
    rows = []
    for d in range(120):
        w = rng.choices(words, k=rng.randrange(60))
        if d % 3:
            t = rng.choice(items[:25])[1].split()
            for _ in range(rng.randrange(5)):
                p = rng.randrange(len(t))
                t[p : p + 1] = rng.choice([["zq"], [], [t[p], "yy"]])
                t = t or ["zq"]
            w[5:5] = t
        rows.append((d, " ".join(w)))
    rows += [rows[1], (7, "clean row of a shared id"), (None, rows[1][1])]

    def nearest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            now = [row[0] + 1]
            for j, y in enumerate(b):
                now.append(min(row[j] + (x != y), row[j + 1] + 1, now[j] + 1))
            row = now
        return min(row)

    cut = lambda t: re.findall(r"[a-z0-9]+", (t or "").lower())
    want = sorted([(d, i) for d, t in rows for i, b in items if cut(b) and nearest(cut(b), cut(t)) <= decontam.allowed(len(cut(b)))], key=repr)
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontam.contaminated(docs, bench), "doc_id", "item_id") == want and 40 < len(want)
    hit = {(d, t) for d, t in rows for i, b in items if cut(b) and nearest(cut(b), cut(t)) <= decontam.allowed(len(cut(b)))}
    assert rows_of(decontam.decontaminate(docs, bench), "doc_id", "text") == sorted([x for x in rows if x not in hit], key=repr)


def test_edit_distance():
    assert decontam.edit_distance([1, 2, 3, 4], [9, 1, 2, 7, 4, 9], 1) == (1, 1, 5)
    assert decontam.edit_distance([1, 2, 3], [4, 5], 1) is None


def brute_letters(text):
    import unicodedata

    s = re.sub(r"[\W\d_]+", " ", unicodedata.normalize("NFC", text or "").lower()).strip()
    return s.encode() if any(c.isalpha() for c in s) else b""


def brute_dictionaries(spark, df):
    """The first rows of each language by hash, short ones first, until they come to the dictionary's size."""
    rows = df.where("lang IS NOT NULL AND octet_length(text) > 0").select("lang", "text", "doc_id", F.xxhash64("doc_id", F.octet_length("text")).alias("h")).collect()
    out = {}
    for lang in {r.lang for r in rows}:
        taught = []
        for r in sorted((r for r in rows if r.lang == lang and zlib.crc32(str(r.doc_id).encode()) % 4 != 2 or (r.lang == lang and r.doc_id is None)), key=lambda r: (len(r.text.encode()) > 16384, r.h))[:200]:
            if sum(map(len, taught)) < 96 * 1024:
                taught.append(brute_letters(r.text))
        out[lang] = b" ".join(filter(None, taught))
    return {k: v for k, v in out.items() if v}


def brute_language(dictionaries, text):
    import zstandard

    s, sizes = brute_letters(text), []
    if not s:
        return "und", 0.0
    for lang in sorted(dictionaries):
        known = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=6, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append((sum(len(coder.compress(s[i : i + 4096])) for i in range(0, len(s), 4096)), lang))
    (best, lang), (second, _) = sorted(sizes)[:2]
    return lang, (second - best) / second


def test_language_by_brute_force(spark):
    big = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(big, langid.train(big.where(~langid.held_out()))).collect()}
    known = brute_dictionaries(spark, big)
    assert got == {r.doc_id: brute_language(known, r.text) for r in big.collect()}


def brute_leak(item, text):
    """Whether a passage of text is within a fifth of the item's words, by the whole table of edit distances."""
    import numpy as np

    row = np.zeros(len(text) + 1, np.int64)
    place = np.arange(len(text) + 1)
    for i, a in enumerate(item, 1):
        now = row + 1
        now[0] = i
        now[1:] = np.minimum(now[1:], row[:-1] + np.array([b != a for b in text], bool))
        row = np.minimum.accumulate(now - place) + place
    return len(item) > 0 and row.min() <= int(0.2 * len(item))


def test_pipeline(spark):
    """All five stages against brute-force versions, on rows that are odd in every way."""
    import corpus_pipeline
    import tiktoken
    import public_tokenizers

    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    long = " ".join(t for _, t, lang, *_ in real if lang == "en")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    odd = [(9001, None, "en", "s", 1), (9002, "", None, None, None), (9003, "12 34 !", "en", "s", 1), (9004, long, "en", "s", 9), (9005, long + " and more of it", "en", "s", 9), (None, long + " once more", None, None, None)]
    odd += [real[3], (real[3][0], "The other text that has the id of another row and is not like it.", "en", None, 3), (9006, real[5][1].replace(" ", "\t\n"), "en", "s", 3), (9007, real[7][1] + " " + item + " " + real[9][1], "en", "s", 4)]
    names = "doc_id long, text string, lang string, source string, n_chars long, row string, text_key long, score string, `group` int, _text string, kept boolean"
    docs = spark.createDataFrame([(*r, "clash", 1, "c", 2, "t", True) for r in real + odd], names).repartition(3)
    out = docs
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    got = rows_of(out, *columns)
    # Language.
    known = brute_dictionaries(spark, docs)
    rows = [(i, t, lang) for i, t, lang, *_ in real + odd]
    told = [brute_language(known, t) for _, t, _ in rows]
    rows = [(i, t) for (i, t, _), (lang, score) in zip(rows, told, strict=True) if lang != "und" and score >= 0.002]
    # Exact copies, then near copies: the smallest id stays, null being the largest.
    size = lambda x: (x[0] is None, x[0] or 0)
    first = {}
    for x in sorted(rows, key=size):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", x[1]), x)
    rows = list(first.values())
    sets = [frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w := re.sub("[A-Z]", lambda m: m[0].lower(), t).split()) >= 5 else frozenset([tuple(w)] * bool(w)) for _, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((root[a], root[b]))
                root = [lo if x == hi else x for x in root]
    rows = [min((rows[k] for k in range(len(rows)) if root[k] == r), key=size) for r in set(root)]
    # Passages of the benchmark.
    words = lambda t: re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(brute_leak(b, words(t)) for b in items)]
    # Tokens.
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(x.split()[0]): int(x.split()[1]) for x in open(path, "rb").read().splitlines() if x}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=repr) and len(got) > 100
    assert {9001, 9002, 9003, 9005, 9006, 9007}.isdisjoint(x[0] for x in got)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_sql_of_queries(spark):
    import duckdb

    from gazetta.llm import queries

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in queries.oracle_sql().items():
        want, got = con.sql(sql), queries.queries()[name](spark, SF)
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        order = [want.columns.index(c) for c in columns]
        assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
