from __future__ import annotations

import pytest

from barloom.llm import urls

CASES = [
    ("http://a.example.net/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/en", "example.net", "/en", "net/", "block"),
    ("https://EXAMPLE.Net/EN/1", "example.net", "/EN/1", "net/", "block"),
    ("http://example.net", "example.net", "", None, "allow"),
    ("http://net?/x", "net", "", None, "allow"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("x://b.example.com/de/a://c", "b.example.com", "/de/a://c", "example.com/de/", "block"),
    ("http://example.org#/fr/", "example.org", "", None, "allow"),
    ("http://example.org/fr/", "example.org", "/fr/", "org/fr/", "allow"),
    ("http://example.net:80/en/", "example.net:80", "/en/", None, "allow"),
    ("example.net/en/", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]


def test_urls(spark):
    rows = [(i, c[0], "clash") for i, c in enumerate(CASES)] + [(None, CASES[0][0], "clash"), (0, CASES[0][0], "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, verdict string").repartition(3)
    got = urls.filter_urls(df).collect()
    assert sorted((tuple(r) for r in got if r.page_id), key=lambda r: r[0]) == [
        (i, *c[1:]) for i, c in enumerate(CASES) if i
    ]
    assert sum(r.page_id is None for r in got) == 1
    assert sum(r.page_id == 0 for r in got) == 2
    assert urls.filter_urls(df.limit(0)).count() == 0


def test_precedence():
    rules = [("block", "a.com", "/x"), ("allow", "a.com", "/x/y/"), ("allow", "b.a.com", ""), ("allow", "c.com", "/"), ("block", "c.com", "/")]
    trie = urls.build_trie(rules)
    assert urls.look_up(trie, "a.com", "/xyz") == ("block", "a.com/x")
    assert urls.look_up(trie, "a.com", "/x/y/z") == ("allow", "a.com/x/y/")
    assert urls.look_up(trie, "a.com", "/y") is None
    assert urls.look_up(trie, "q.b.a.com", "/x/y/z") == ("allow", "b.a.com")
    assert urls.look_up(trie, "c.com", "/") == ("block", "c.com/")  # of equal rules the block
    assert urls.look_up(urls.build_trie([]), "c.com", "/") is None


def test_size_of_the_trie_is_checked(monkeypatch):
    monkeypatch.setattr(urls, "MAX_RULES", 2)
    with pytest.raises(ValueError):
        urls.build_trie([("block", f"{i}.com", "/") for i in range(3)])
