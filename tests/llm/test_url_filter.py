import math

from pyspark.sql import functions as F

from snapmart.llm import url_filter as uf

URLS = [
    ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/fr/1", "example.org", "/fr/1", "org/", "allow"),
    ("http://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
    ("x://www.com/de/", "www.com", "/de/", "com/de/", "block"),
    ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("x://com/fr", "com", "/fr", None, None),
    ("x://a.org", "a.org", "", None, None),
    ("x://a.org?/es/", "a.org", "", None, None),
    ("x://a://b/de/", "a:", "//b/de/", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("x://É.COM/É\n/de/", "É.com", "/É\n/de/", None, None),
    ("x://" + "a" * 50_000 + "/b", "a" * 50_000, "/b", None, None),
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "c", "d") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_rules_hosts_and_paths(spark):
    model = uf.UrlModel((0.0,) * uf.BUCKETS, -math.inf)
    got = {r.page_id: r for r in uf.judge(pages(spark, [u[0] for u in URLS]), model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")


def slow_train(rows, rounds=uf.ROUNDS):
    """The same gradient steps on lists of buckets."""
    n, positive = len(rows), sum(t for _, t in rows)
    weights, squares, bias, bias_square = [0.0] * uf.BUCKETS, [0.0] * uf.BUCKETS, 0.0, 0.0
    for _ in range(rounds):
        sums, total = {}, 0.0
        for buckets, target in rows:
            norm = math.sqrt(max(len(buckets), 1))
            p = 1 / (1 + math.exp(-(sum(weights[b] for b in buckets) / norm + bias)))
            slope = (p - target) * (0.5 * n / positive if target else 0.5 * n / (n - positive))
            total += slope
            for b in buckets:
                sums[b] = sums.get(b, 0.0) + slope / norm
        bias_square += (total / n) ** 2
        bias -= uf.RATE * (total / n) / math.sqrt(bias_square + 1e-12)
        for b, s in sums.items():
            slope = s / n + uf.RIDGE * weights[b]
            squares[b] += slope**2
            weights[b] -= uf.RATE * slope / math.sqrt(squares[b] + 1e-12)
    return weights, bias


def test_training_against_brute_force_and_held_out_urls(spark):
    def urls(word, ids):
        return [f"http://{word}-{i}.example.net/{'offers' if word == 'pills' else 'news'}/{i}" for i in ids]

    known = [(u, "block") for u in urls("pills", range(30))] + [(u, "allow") for u in urls("paper", range(50))]
    labelled = spark.createDataFrame(known + known, "url string, verdict string")
    model = uf.train(labelled)
    host, path = uf.host_of(F.col("url")), uf.path_of(F.col("url"))
    rows = labelled.distinct().select(uf.features(host, path), (F.col("verdict") == "block").cast("int")).collect()
    weights, bias = slow_train([(list(b), t) for b, t in rows])
    assert max(abs(a - b) for a, b in zip(weights, model.weights)) < 1e-3 and abs(bias - model.bias) < 1e-3
    judged = uf.judge(pages(spark, urls("pills", range(100, 120)) + urls("paper", range(100, 120))), model).collect()
    assert all((r.verdict == "block") == (r.page_id < 20) for r in judged)


def test_few_labels_and_empty_tables(spark):
    labels = "url string, verdict string"
    assert uf.train(spark.createDataFrame([], labels)).bias == -math.inf
    one_sided = uf.train(spark.createDataFrame([("http://a.b/", "block"), (None, "allow")], labels))
    assert uf.judge(pages(spark, ["x://c.net/", None]), one_sided).filter("verdict = 'block'").count() == 2
    assert uf.judge(pages(spark, ["x"]).limit(0), one_sided).count() == 0


def test_no_python_in_the_plan(spark):
    judged = uf.judge(pages(spark, ["x"]), uf.UrlModel((0.5,) * uf.BUCKETS, 0.1))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
