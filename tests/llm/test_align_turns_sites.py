"""Operators 11 to 13 against brute force: token alignment, conversation repair, main text of pages."""

import functools
import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from settlekit.llm import conversation_dawg as C
from settlekit.llm import site_templates as S
from settlekit.llm import token_align as T
from settlekit.llm import tokens
from settlekit.llm.markup import parse
from tests.conftest import SF_SMALL

A, B = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model")

# -- alignment ----------------------------------------------------------------


@pytest.fixture(scope="module")
def two():
    return T.TwoTokenizers(A, B)


def plain_ids(text):
    """(A ids, A bytes, B ids, B bytes) straight from the libraries, or None where bytes don't come back."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return None
    a_lib, b_lib = plain_ids.__dict__.setdefault("libs", (
        Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)))
    a_lib.encode_special_tokens = True
    back = {c: bytes([b]) for b, c in tokens._LETTERS.items()}
    enc = a_lib.encode(" " + text, add_special_tokens=False)
    a = [b"".join(back[c] for c in t) for t in enc.tokens]
    b_ids = b_lib.encode(text)
    b = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i)
         else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    want = (" " + text).encode()
    return (enc.ids, a, b_ids, b) if b"".join(a) == want == b"".join(b) else None


def plain_links(a, b):
    """Overlapping occurrences by trying byte ranges; groups by the intersection of the ends."""
    def ranges(parts):
        ends = list(itertools.accumulate(map(len, parts)))
        return list(zip([0, *ends[:-1]], ends))

    ra, rb = ranges(a), ranges(b)
    links, j = [], 0
    for i, (s, e) in enumerate(ra):
        while rb[j][1] <= s:
            j += 1
        k = j
        while k < len(rb) and rb[k][0] < e:
            links.append((i, k))
            k += 1
    common = sorted({e for _, e in ra} & {e for _, e in rb})
    groups, i, j = [], 0, 0
    for end in common:
        i2 = next(x for x in range(i, len(ra)) if ra[x][1] == end) + 1
        j2 = next(x for x in range(j, len(rb)) if rb[x][1] == end) + 1
        groups.append((range(i, i2), range(j, j2)))
        i, j = i2, j2
    return links, groups


def plain_alignment(rows):
    """{row number: (doc_id, n_a, ..., groups_sha256)} by the definitions."""
    counts, found = Counter(), []
    for doc_id, text in rows:
        got = plain_ids(text)
        if got is None:
            found.append((doc_id, None))
            continue
        a_ids, a, b_ids, b = got
        links, groups = plain_links(a, b)
        pairs = [(a_ids[i], b_ids[k]) for i, k in links]
        counts.update(set(pairs))
        text = ";".join(",".join(str(a_ids[i]) for i in x) + "|" + ",".join(str(b_ids[k]) for k in y) for x, y in groups)
        found.append((doc_id, (len(a), len(b), len(groups), pairs, hashlib.sha256(text.encode()).hexdigest())))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(n, best.get(x, 0))
    return [(d, 0, 0, 0, 0, 0, 0, "") if f is None else
            (d, *f[:3], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]), f[4])
            for d, f in found]


ODD = ["", None, " ", "  ", "\n", "a", " a", "a ", "a  b", "foo\nbar\r\nbaz;\r\n", "\t\tx\x0b\x0cy", "<s> x </s><unk>",
       "<|endoftext|> plain <|endoftext|>", "café naïve \U0001F600 日本語", "a▁b", "▁",
       "\xa0x　y  z", "\x00\x01 q", "é", "don't we'll I'm 3.14 1000000", "x" * 5000,
       " ".join(["antidisestablishmentarianism"] * 300), "trailing  \n\n  ", "{'a': [1, 2]}\r", "﻿bom", "​zero"]


def test_alignment_equals_brute_force(spark):
    rng = random.Random(5)
    alphabet = "ab C,.;'\n\t\r 1éß中<|>"
    rows = list(enumerate(ODD)) + [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))))
                                   for k in range(150)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, pair string, row int")
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).collect()]
    rows += [(1000 + d, t) for d, t in real] + [(1000 + real[0][0], real[0][1])] * 2   # repeated rows
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, pair string, row int")
    want = sorted(plain_alignment(rows))
    for known in (T.KNOWN_PAIRS, 40, 0):   # all pairs known, some, none: the same result
        assert sorted(map(tuple, T.report(docs, A, B, known_pairs=known).collect())) == want


def test_stretches_cover_every_common_end_once():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 60)
        ends = [sorted({n, *(k for k in range(1, n) if rng.random() < p)}) for p in (rng.random(), rng.random())]
        found = [(x + s, y + s) for x, y, c in zip(*T.common_ends(*ends)) for s in range(c)]
        assert [ends[0][x] for x, _ in found] == [ends[1][y] for _, y in found] == sorted(set(ends[0]) & set(ends[1]))


def test_chunks_give_the_ids_of_the_whole_text(two):
    texts = [t for t in ODD if t]
    seen = {}
    for places, a, an, b, bn in two.encode([t.encode() for t in texts]):
        for k, x, y in zip(places, np.split(a, np.cumsum(an)[:-1]), np.split(b, np.cumsum(bn)[:-1])):
            seen[texts[k]] = (x.tolist(), y.tolist())
    for t in texts:
        got = plain_ids(t)
        assert seen.get(t) == (None if got is None else (got[0], got[2]))


def test_alignment_of_empty_and_very_long_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert T.report(empty, A, B).collect() == []
    long = "The quick brown fox jumps over the lazy dog. " * 40_000   # 1.8 MB, over a slice
    row = T.report(spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string"), A, B).orderBy("doc_id").collect()
    a_ids, a, b_ids, b = plain_ids(long)
    assert row[0].n_a == len(a_ids) and row[0].n_b == len(b_ids) and tuple(row[1])[1:] == (0, 0, 0, 0, 0, 0, "")


# -- conversations -------------------------------------------------------------

SPACE = set(" \t\n\x0b\x0c\r")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        if code == 1:
            text = ""
        elif code == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif code == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def plain_repair(conv, rows):
    def same(r):
        return hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()

    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), same(r)))
    turns = {r[1] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, faults = set(), []
    for r in rows:
        ends = [c for c in r[3] if c not in SPACE]
        faults.append("blank" if not ends else "duplicate" if r[2:] in seen else
                      "truncated" if ends[-1] not in ".!?" else "")
        seen.add(r[2:])
    initials = [r[2][:1] for r in rows]
    illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))

    @functools.cache
    def best(i, state, in_a_row):
        """(cost, audit, repaired) least by cost, then audit; state: what the last row was."""
        out = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        here = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[here]
        if in_a_row < 3:
            c, x, t = best(i, here, in_a_row + 1)
            out.append((c + 5, "I" + x, (f"{name}:", *t)))
        if i < len(rows):
            c, x, t = best(i + 1, state, 0)
            out.append((c + 2, "D" + x, t))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                c, x, t = best(i + 1, here, 0)
                out.append((c + 1 + more, "R" + x, (f"{name}:{rows[i][3]}", *t)))
                if initials[i] == here or (initials[i] == "s" and state == ""):
                    c, x, t = best(i + 1, initials[i], 0)
                    out.append((c + more, "K" + x, (f"{rows[i][2]}:{rows[i][3]}", *t)))
        return min(out) if out else (1 << 40, "", ())

    cost, audit, kept = best(0, "", 0)
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(kept).encode()).hexdigest())


def plain_report(rows):
    damaged = plain_damage(rows)
    return sorted((plain_repair(c, [r for r in damaged if r[0] == c]) for c in {r[0] for r in rows}), key=str)


def some_conversations(n, seed=1):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "User", "", None, "ux"]
    texts = ["Hello.", "Why?", "No end", "", "  \n", None, "Yes!", "Hello.", "a. ", "...", "été \U0001F600"]
    rows = []
    for c in range(n):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(0, 9)):
            rows.append((c if c else None, None if rng.random() < .05 else turn, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
    return rows


_CONV = "conv_id long, turn long, role string, text string, same string, copies_of int, reverse string"


def conv_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], _CONV)


def test_repair_equals_brute_force(spark):
    rows = some_conversations(250)
    rows += [r for r in rows if r[0] == 7]   # repeated rows
    got = C.report(C.damage(conv_table(spark, rows))).collect()
    assert sorted(map(tuple, got), key=str) == plain_report(rows)


def test_repair_of_the_given_conversations(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = C.report(C.damage(table)).collect()
    assert sorted(map(tuple, got), key=str) == plain_report([tuple(r) for r in table.select(
        "conv_id", "turn", "role", "text").collect()])


def test_repaired_rows_are_legal_and_empty_tables_work(spark):
    import re

    rows = some_conversations(80, 3)
    by = {}
    for r in sorted(C.repaired(C.damage(conv_table(spark, rows))).collect(), key=lambda r: (str(r.conv_id), r.position)):
        by[r.conv_id] = by.get(r.conv_id, "") + r.role[0]
    assert by and all(re.fullmatch("(s?(ua)+)?", x) for x in by.values())
    assert C.report(C.damage(conv_table(spark, []))).collect() == []


def test_a_long_conversation_and_many_copies(spark):
    rows = [(1, t, ["user", "assistant"][t % 2], f"Turn {t}{'.' * (t % 7 > 0)}") for t in range(3000)]
    rows += [(c, t, "user", "Hi.") for c in range(2, 400) for t in range(3)]
    damaged = plain_damage(rows)
    got = {r.conv_id: r for r in C.report(C.damage(conv_table(spark, rows))).collect()}
    assert len(got) == 399
    import sys
    sys.setrecursionlimit(20_000)
    assert tuple(got[5]) == plain_repair(5, [r for r in damaged if r[0] == 5])
    r = got[1]
    assert r.audit.count("D") + r.audit.count("K") + r.audit.count("R") == sum(1 for x in damaged if x[0] == 1)


def test_nodes_are_made_once_for_a_shared_suffix():
    auto = C.SuffixAutomaton()
    auto.solve("".join(reversed("uaua")))
    kept = list(auto.nodes)
    auto.solve("".join(reversed("Xuaua")))
    assert auto.nodes[:5] == kept and all(x is y for x, y in zip(auto.nodes, kept))


# -- pages --------------------------------------------------------------------


def text(html, frame=frozenset(), main=frozenset()):
    return S.Page(html).text(frame, main)[0]


@pytest.mark.parametrize("html,want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a b"), ("<p>a<b>b</b>c<br>d</p>", "abc d"),
    ("<ul><li>x<li>y</ul>", "x y"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("a<!-- no --->b<!doctype x>c<?php d ?>", "abc"), ("<script>var t='</p>';</script>x<style>p{}</style>", "x"),
    ("<nav>m</nav><article><h1>T</h1><p>B &lt;b&gt; &#233;&nbsp;\n\n&eacute;</p></article><footer>f</footer>", "T B <b> é é"),
    ("<article><p>a</p><div class='ad'>b</div><aside>c</aside><form>d</form><p hidden>e</p>f</article>", "a f"),
    ("<body><form><div class='has-sidebar'><main>x</main></div></form><div>y</div>", "x"),
    ("<article>a<section id=comments><article>c</article></section></article>", "a"),
    ("<article><header><h1>t</h1></header>a</article><header>h</header>", "t a"),
    ("<div role=navigation>n</div><div id='top-menu'>m</div><p>x", "x"), ("a < b and c > d", "a < b and c > d"),
    ("<p title='>'>x</p", "x"), ("<p>x</p><a href=", "x"), ("<p>a</b></i></span>b", "ab"), ("<DIV>A</DIV><P>B", "A B"),
    ("&am &amp &copy &notit; &#0; &bogus;", "&am & © ¬it; � &bogus;"), ("<p>a</div></article>b</p>", "ab"),
    ("<title>t</title><h1>h", "h"), ("<textarea>x</textarea>y<select><option>z</select>", "y"),
    ("<p>" + "<b>" * 5000 + "deep", "deep"), ("<div>" * 30000 + "x", "x"), ("<p>a</p>\x00b", "a \x00b"),
])
def test_text_of_markup(html, want):
    assert text(html) == want


def test_subtree_hashes_ignore_attributes_and_white_space():
    one, other, third = (parse(f"<div {a}>x{s}<p>y</p></div>").kids[0].digest for a, s in (("", " "), ("id=1", "\n "), ("", "z")))
    assert one == other != third


def site(spark):
    """A host without marked articles: a menu and a note that recur, articles that differ, and copies of one."""
    rows = []
    for k in range(40):
        body = "".join(f"<p>Words {k} of paragraph {j} that nobody else has written {k * j}.</p>" for j in range(8))
        if k >= 34:
            body = "<p>A copied article.</p><p>It has two paragraphs of its own.</p>" + "<p>And a long tail of text.</p>"
        rows.append((k, f"https://Site.example/{k}",
                     f"<html><body><div><span>Home</span> <span>News</span></div><div>{body}<p>Read our letter.</p></div>"
                     f"<div>Imprint of the site</div></body></html>"))
    rows += [(100, "https://alone.example/", "<p>One page only.</p><div>Imprint of the site</div>"),
             (101, None, "<div>Imprint of the site</div>"), (102, "https://site.example/x", None), (103, "odd", ""),
             (3, "https://Site.example/3", rows[3][2])]
    return spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, n int"), rows


@pytest.mark.parametrize("broadcast_rows", [S.BROADCAST_ROWS, 0])
def test_templates_of_a_site_are_removed(spark, broadcast_rows):
    pages, rows = site(spark)
    got = S.extract(pages, broadcast_rows=broadcast_rows).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for k in range(34):
        want = " ".join(f"Words {k} of paragraph {j} that nobody else has written {k * j}." for j in range(8))
        assert by[k].text == want and by[k].n_chars == len(want) and by[k].n_templates == 3
    # copies of one article stay whole: only what most pages of the site share goes
    assert by[36].text == "A copied article. It has two paragraphs of its own. And a long tail of text."
    assert by[100].text == "One page only. Imprint of the site" and by[101].text == "Imprint of the site"
    assert (by[102].text, by[102].n_chars, by[103].text) == ("", 0, "")


def test_counts_equal_brute_force(spark):
    pages, rows = site(spark)
    want = Counter()
    for _, url, html in rows:
        host = url.split("/")[2].lower() if url and "://" in url else ""
        if host:
            want.update((host, h) for h in (S.subtrees(parse(html)) if html else set()) | {0})
    got = {(r.host, r.node): r.n for r in S.subtree_counts(S._columns(pages, "page_id", "url", "html")).collect()}
    assert got == dict(want)


def test_articles_of_the_given_pages(spark):
    import html as H
    import re

    table = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = {}
    for r in table.collect():
        inner = re.search("<article>(.*)</article>", r.html, re.S).group(1)
        want[r.page_id] = " ".join(H.unescape(re.sub("</?b>", "", re.sub("</?(?:p|br|h1)>", " ", inner))).split())
    assert {r.page_id: r.text for r in S.extract(table).collect()} == want
    assert S.extract(table.filter("false")).collect() == []


def test_a_very_long_page(spark):
    body = "<p>word and word &amp; more</p>" * 200_000   # 6 MB
    got = S.extract(spark.createDataFrame([(1, "https://a.example/1", f"<article>{body}</article>")],
                                          "page_id long, url string, html string")).first()
    assert got.n_chars == 200_000 * len("word and word & more ") - 1
    assert S.extract(spark.range(0).select(F.col("id").alias("page_id"), F.lit("").alias("url"),
                                           F.lit("").alias("html"))).collect() == []
