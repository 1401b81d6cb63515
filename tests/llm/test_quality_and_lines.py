import re
from collections import Counter

from matchlake.llm import line_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def plain_kept(text):
    """Every rule on its own, as its description says."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = {i + k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = Counter(x for x in text.split("\n") if WORD.search(x))
    again = sum(lines.values()) - len(lines)
    upper, lower = sum(c.isupper() for c in text), sum(c.islower() for c in text)
    return not (
        n < 10
        or len(covered) / n > 0.2
        or sum(c in "#*$%&|<>" for c in text) / n > 0.2
        or (again >= 3 and again / sum(lines.values()) > 0.3)
        or (upper + lower and upper / (upper + lower) > 0.6)
        or sum(len(w) - len(w.rstrip("!?")) > 1 for w in words) / n > 0.2
        or sum(a == b for a, b in zip(words, words[1:])) / n > 0.3
        or sum(not any(c.isalpha() for c in w) for w in words) / n > 0.4
        or sum(map(len, words)) / n > 100
    )


def test_verdicts_equal_a_plain_judgement(some_docs):
    truth = {r["doc_id"]: plain_kept(r["text"]) for r in some_docs.collect()}
    found = by_id(quality_rules.quality_report(some_docs), "kept")
    assert {k: v[0] for k, v in found.items()} == truth
    assert sorted(r["doc_id"] for r in quality_rules.keep_good(some_docs).collect()) == sorted(d for d, k in truth.items() if k)
    assert 10 < sum(truth.values()) < len(truth) - 10


def test_the_chain_goes_by_what_is_left():
    # a catches most, but what it leaves only c catches; b is the same as a and slower.
    masks = {0b011: 60, 0b010: 1, 0b100: 20, 0: 500}
    assert quality_rules.chained(["a", "b", "c"], masks, {"a": 1.0, "b": 2.0, "c": 1.0}) == ["a", "c", "b"]
    assert quality_rules.chained(["a", "b", "c"], masks, {"a": 9.0, "b": 9.0, "c": 0.1}) == ["c", "b", "a"]
    assert quality_rules.chained(["a"], {}, {}) == ["a"]


def test_counts_equal_a_plain_count(some_docs):
    found = by_id(
        quality_rules.quality_report(some_docs), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )
    for r in some_docs.collect():
        text = r["text"] or ""
        words = WORD.findall(text)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = {w for w in windows if windows.count(w) > 1} if len(words) < 2000 else None
        lines = [x for x in text.split("\n") if WORD.search(x)]
        n_words, chars, symbols, dups, repeat, failed, kept = found[r["doc_id"]]
        assert (n_words, chars) == (len(words), sum(map(len, words)))
        assert symbols == sum(c in "#*$%&|<>" for c in text)
        assert dups == sum(x in lines[:i] for i, x in enumerate(lines))
        if often is not None:
            covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
            assert repeat == len(covered)
        assert failed == (n_words < 10 or 100 * repeat > 20 * n_words)
        assert not (failed and kept)


def test_every_rule_rejects_and_the_order_does_not_matter():
    good = "A plain text of some length, with nothing odd in any of its many words.\n" * 1
    assert quality_rules.passes(good, WORD.findall(good), list(quality_rules.RULES))
    bad = {
        "too_many_symbols": "a | b | c | d | e | f",
        "too_many_duplicate_lines": "x y z\n" * 4,
        "shouting": "THIS IS ALL SHOUTED",
        "exclaiming": "wow!! so!! good!!",
        "stuttering": "ah ah ah oh oh oh",
        "few_letters": "1 2 3 4 five",
        "endless_words": "x" * 300,
    }
    for name, text in bad.items():
        assert quality_rules.RULES[name](text, WORD.findall(text)), name
        for order in (list(quality_rules.RULES), list(quality_rules.RULES)[::-1]):
            assert not quality_rules.passes(text, WORD.findall(text), order)


def test_quality_of_odd_documents(odd_docs, no_docs):
    report = quality_rules.quality_report(odd_docs).collect()
    assert len(report) == odd_docs.count()
    assert {r["doc_id"]: r["n_words"] for r in report}[2] == 0
    kept = quality_rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 5, 5, 6, 7]
    assert quality_rules.quality_report(no_docs).count() == quality_rules.keep_good(no_docs).count() == 0


def one_edit(a, b):
    n, m = len(a), len(b)
    at = next((i for i in range(min(n, m)) if a[i] != b[i]), min(n, m))
    if n == m:
        return a[at + 1 :] == b[at + 1 :]
    return abs(n - m) == 1 and (a[at + 1 :] == b[at:] if n > m else a[at:] == b[at + 1 :])


def plain_line_dedup(rows):
    """(id -> text), looking at every pair of lines."""
    first = {}
    for doc, text in sorted(rows):
        for at, line in enumerate(text.split("\n")):
            words = tuple(WORD.findall(line))
            if len(words) >= line_dedup.MIN_WORDS:
                first.setdefault(words, (doc, at))
    long = [w for w in first if len(w) >= line_dedup.MIN_WORDS_NEAR]
    near = {w for w in long if any(first[v] < first[w] and one_edit(v, w) for v in long)}
    out = {}
    for doc, text in rows:
        left = []
        for at, line in enumerate(text.split("\n")):
            words = tuple(WORD.findall(line))
            if words not in first or (words not in near and first[words] == (doc, at)):
                left.append(line)
        out[doc] = "\n".join(left)
    return out


def test_lines_equal_a_plain_comparison(some_docs):
    rows = [(r["doc_id"], r["text"] or "") for r in some_docs.collect()]
    found = by_id(line_dedup.line_report(some_docs), "text")
    assert {k: v[0] for k, v in found.items()} == plain_line_dedup(rows)


def test_edits_at_every_place(spark):
    base = [f"w{i}" for i in range(12)]
    lines = [base]
    for i in range(12):
        lines += [base[:i] + base[i + 1 :], base[:i] + ["x"] + base[i + 1 :], base[:i] + ["y"] + base[i:]]
    lines.append(["two", "edits", *base[2:]])
    rows = [(i, " ".join(w)) for i, w in enumerate(lines)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(line_dedup.line_report(df), "text")
    assert {k: v[0] for k, v in found.items()} == plain_line_dedup(rows)


def test_what_is_left_of_a_text_is_made_once(spark, capsys):
    same, long = "one two three four", " ".join(f"word{i}" for i in range(30))
    rows = [(0, f"{same}\n{long}"), (1, f"{same}\nfive six"), (2, same), (3, f"{same}\n{long} more"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for least, empty in ((0, False), (2, True), (4, False)):
        df = line_dedup.dedup_lines(docs, drop_empty=empty, least_words=least, least_share=least / 100)
        # A second mention, or one inside a function of each line, would do the work again.
        df.explain()
        plan = capsys.readouterr().out
        assert plan.count("array_join(") == 1 and plan.count("split(") == 1
        stump = [] if least > 2 else [(1, "five six")]
        gone = [] if empty or least else [(2, ""), (3, "")]
        assert sorted(map(tuple, df.collect())) == [rows[0], *stump, *gone, *rows[4:]]


def test_lines_of_odd_documents(odd_docs, no_docs):
    left = line_dedup.dedup_lines(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.filter("__text <> 'own __text' or key <> 'own key'").isEmpty()
    # Without an id comes first; its copies and the line one word away go, and so do their documents.
    assert sorted((r["doc_id"] or 0) for r in left.collect()) == [0, 1, 2, 3, 4, 8]
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert line_dedup.line_report(odd_docs).count() == odd_docs.count()


def test_lines_of_rows_that_share_or_lack_an_id(spark):
    line = lambda k: " ".join(f"{k}w{i}" for i in range(12))
    texts = [f"{line('common')}\n{line(k)}\n{line('near')} {k}" for k in range(6)]
    rows = [(None, t) for t in texts[:3]] + [(7, t) for t in texts[3:5]] + [(9, texts[5])]
    found = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    left = [x for r in found for x in r["text"].split("\n")]
    assert sorted(left) == sorted({line("common"), *map(line, range(6)), *(x for x in left if x.startswith("nearw"))})
    assert len([x for x in left if x.startswith("nearw")]) == 1
    # What stays of the common lines is in a row without an id, which come first.
    assert [r["doc_id"] for r in found if line("common") in r["text"] or "nearw0" in r["text"]] == [None]


def test_lines_without_spaces(spark):
    chinese = "今天北京的天气非常好我们一起去公园散步吧"
    thai = "วันนี้อากาศดีมากเราไปเดินเล่นกันเถอะ"
    mixed = "東京のオフィスで使う version 2 の設定を確認してください"
    url = "https://example.org/a/very/long/path/that/repeats?x=1"
    lines = [chinese, thai, mixed, url]
    changed = [chinese.replace("好", "坏"), thai.replace("ดี", "ด"), mixed.replace("設", "指"), url + "2"]
    rows = [(1, "\n".join(lines)), (2, "\n".join([*lines, "own"])), (3, "\n".join(changed))]
    rows += [(k, "short 行\n第一章") for k in (4, 5)] + [(6, "𠮷" + chinese[2:] + "\n" + chinese[:-2])]
    found = by_id(line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string")), "text")
    assert {k: v[0] for k, v in found.items()} == {
        1: rows[0][1], 2: "own", 3: changed[3], 4: rows[3][1], 5: rows[4][1], 6: rows[5][1],
    }
