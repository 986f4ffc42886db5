"""Fetching through a cache with a made transport: back-off, what is gone, redirects, and one host after the other."""

from shoalmark.operators import graph, merge
from shoalmark.sources.fetching import Fetcher, cache_key, fetched


def test_fetcher(tmp_path):
    asked, waited = [], []
    answers = {"https://a.jp/1": [(200, "https://a.jp/1", "<p>1")], "https://a.jp/busy": [(503, "", None), (429, "", None), (200, "https://a.jp/busy", "ok")], "https://a.jp/gone": [(404, "https://a.jp/gone", None)], "https://a.jp/out": [(200, "https://b.jp/", "x")], "https://a.jp/never": [(503, "", None)] * 9}

    def transport(url, data):
        asked.append((url, data))
        return answers[url].pop(0)

    f = Fetcher(str(tmp_path), transport, interval=1.0, wait=waited.append, same_host=True)
    assert f.get("https://a.jp/1")["html"] == "<p>1" and f.get("https://a.jp/1")["html"] == "<p>1" and len(asked) == 1
    assert f.get("https://a.jp/busy")["html"] == "ok" and waited == [1.0, 2.0, 4.0]
    assert f.get("https://a.jp/gone")["status"] == "gone" and f.get("https://a.jp/gone")["status"] == "gone" and len(asked) == 5
    assert f.get("https://a.jp/out")["status"] == "gone"
    n = len(asked)
    assert f.get("https://a.jp/never")["html"] is None and len(asked) == n + 6  # five times again, and not kept
    answers["https://a.jp/1"] = [(200, "https://a.jp/1", "posted")]
    assert f.get("https://a.jp/1", "q=2")["html"] == "posted"


def test_hosts_side_by_side(spark, tmp_path):
    folder = str(tmp_path)
    urls = spark.createDataFrame([(f"https://{h}.jp/{i}",) for h in "abc" for i in range(3)] + [("https://a.jp/0",)], "url string")
    rows = fetched(urls, lambda: Fetcher(folder, lambda url, data: (200, url, f"<p>{url}"), wait=lambda s: None)).collect()
    assert len(rows) == 9 and all(r.html == f"<p>{r.url}" for r in rows)
    key = urls.select(cache_key(urls.url).alias("k")).first().k
    assert (tmp_path / f"{key}.json").exists()


def test_shared_folder_is_asked_for(spark, monkeypatch):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: None)})

        class sparkContext:
            master = "spark://host:7077"
            _jsc = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False), "isEmpty": staticmethod(lambda: True)}))}))})

    import pytest

    with pytest.raises(RuntimeError):
        graph.checkpoint_dir(Session)


def test_names_inside_names_by_all_pairs(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("あいう") for _ in range(rng.randint(1, 6)))
    asked, known = [(i, word()) for i in range(60)], [(f"e{i:02d}", word()) for i in range(60)]
    rows = spark.createDataFrame([(i, None, None, n, "P") for i, n in asked], "id int, tel string, host string, nkey string, pref string")
    entities = spark.createDataFrame([(e, None, None, n, "P") for e, n in known], "entity string, tel string, host string, nkey string, pref string")
    got = {r.id: r.hit for r in merge.known_to(rows, entities).collect()}
    for i, n in asked:
        want = min((e for e, m in known if min(len(n), len(m)) >= 3 and (n in m or m in n)), default=None)
        assert got[i] == want, n
