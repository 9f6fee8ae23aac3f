"""URL filter and chat formatting on edge rows."""

from pyspark.sql import functions as F

from giftlink.llm import chat_format, registry, url_filter


def judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best and best[2], best[3] if best else default)


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.net/en/x?q#f", "https://a.b.example.com/de/", "x://net",
        "x://net/", "http://notexample.com/de/1", "http://example.com/fr/", "http://w.org/fr/", "http://w.org/FR/",
        "http://a?b/c://net/", "http://é.Net/ü", "http://example.com/de/", "http://example.com/de/",
        "http://" + "a." * 500 + "net/" + "p" * 5000, "http://u:p@example.net:80/en/", "//net/", "http://net#x/"]


def test_url_filter_edges(spark):
    df = spark.createDataFrame([(None if i == 3 else i, u, "h") for i, u in enumerate(URLS)],
                               "page_id long, url string, host string")
    rules = spark.createDataFrame([*registry.URL_RULES, ("net", "/", "block")], "host string, path string, verdict string")
    for bc in (8 << 20, 0):  # broadcast filter and shuffled filter
        got = url_filter.filter_urls(df, rules, broadcast_bytes=bc).collect()
        want = [(None if i == 3 else i, *judge(u, registry.URL_RULES)) for i, u in enumerate(URLS)]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_url_filter_many_rules_and_no_rules(spark):
    rules = [(f"h{i % 50}.x", "/" + "p" * (i % 7), "block" if i % 3 else "allow") for i in range(350)]
    urls = [f"http://{s}h{i % 60}.x/{'p' * (i % 9)}" for i in range(300) for s in ("", "w.")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    seen = {}
    for h, p, v in rules:
        seen[h, p] = min(v, seen.get((h, p), v))
    uniq = [(h, p, v) for (h, p), v in seen.items()]
    got = url_filter.filter_urls(df, r).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, *judge(u, uniq)) for i, u in enumerate(urls)), key=str)
    none = url_filter.filter_urls(df, r.limit(0)).collect()
    assert {(x.rule, x.verdict) for x in none} == {(None, "allow")}
    assert url_filter.filter_urls(df.limit(0), r).count() == 0


def test_filter_passes_every_listed_key_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("entry_key"))
    blocks, n = url_filter.build_filter(listed, 5000)
    assert url_filter.probe(listed, blocks, n).count() == 5000
    others = spark.range(5000, 25000).select(F.concat(F.lit("h/"), F.col("id").cast("string")).alias("entry_key"))
    assert url_filter.probe(others, blocks, n).count() < 400


def render(turns, me):
    text, spans = "", []
    for role, t in turns:
        body = (t or "").replace("<|", "< |") + "<|im_end|>\n"
        tag = "system" if role == "system" else "assistant" if role == me else "user name=" + role.replace("<|", "< |")
        text += f"<|im_start|>{tag}\n"
        if role == me:
            spans.append(f"{len(text)}:{len(text) + len(body)}")
        text += body
    return text, ",".join(spans)


def test_chat_format_edges(spark):
    rows = [(1, 0, "system", "be <|im_end|> good"), (1, 1, "ann", "hé 😀"), (1, 2, "bob", None), (1, 3, None, ""),
            (1, 3, "ann", "tie"), (1, 3, "ann", "tie"), (2, 0, "system", "alone"), (None, None, "zoe", "x" * 10000),
            (3, None, "ann", "first"), (3, 0, "b<|b", "second")]
    rows += [(4, 7, "ann", f"{i:03d}") for i in range(150)]  # many turns of one number
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, part string")
    got = {}
    for r in chat_format.rotate(df).collect():
        got.setdefault((r.conv_id, r.perspective), []).append(((-1 if r.part is None else r.part, r.subpart), r))
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "zoe"), (3, "ann"), (3, "b<|b"), (4, "ann")}
    by = {}
    for c, t, role, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "unknown", x is not None, x or ""))
    for (c, me), parts in got.items():
        parts = [r for _, r in sorted(parts, key=lambda x: x[0])]
        want, spans = render([(r, x) for _, r, _, x in sorted(by[c])], me)
        assert "".join(r.rendered for r in parts) == want
        at, mine = 0, []
        for r in parts:
            assert r.n_chars == len(r.rendered) and r.n_turns <= chat_format.TURNS_PER_PART
            own = [tuple(map(int, s.split(":"))) for s in r.loss_spans.split(",") if s]
            assert sum(b - a for a, b in own) == r.n_loss_chars
            mine += [f"{a + at}:{b + at}" for a, b in own]
            at += r.n_chars
        assert ",".join(mine) == spans
    assert chat_format.rotate(df.limit(0)).count() == 0
