"""What talks to the outside, with the outside played by functions."""

import json
from datetime import UTC, datetime

import pytest

from hirelens import __main__ as cli
from hirelens.operators import enrich as E
from hirelens.operators.filters import Tokens
from hirelens.sources import notify as N
from hirelens.sources import search_api as S

SEARCH = {"query_id": 1, "q": "x", "location": "l", "max_jobs": 3}


def page(n, token=None, status="Success"):
    return {"search_metadata": {"status": status, "id": "i", "json_endpoint": "u"}, "jobs_results": [{"job_id": k} for k in range(n)], "serpapi_pagination": {"next_page_token": token}}


def client(answers, keys=("k1", "k2"), poll=None):
    told, waits = [], []

    def fetch(params, key):
        told.append((params.get("next_page_token"), key))
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    found = S.SearchClient(fetch, list(keys), poll, sleep=waits.append, now=lambda: datetime(2026, 1, 1, tzinfo=UTC))
    return found, told, waits


def test_pages_and_limit():
    found, told, _ = client([page(2, "t"), page(2, "u")])
    jobs = found.jobs(SEARCH)
    assert [j["job"]["job_id"] for j in jobs] == [0, 1, 0]
    assert [j["page"] for j in jobs] == [1, 1, 2]
    assert told == [(None, "k1"), ("t", "k1")]


def test_keys_rotate():
    found, told, _ = client([page(1, "t"), S.StatusError(429), page(2)])
    assert len(found.jobs(SEARCH)) == 2
    assert [k for _, k in told] == ["k1", "k1", "k2"]
    assert found.exhausted == {"k1"}
    with pytest.raises(S.NoResults):
        client([page(0), page(0)])[0].jobs(SEARCH)


def test_retries_and_polls():
    found, _, waits = client([S.StatusError(503), ConnectionError(), page(0, status="Processing")], poll=lambda url: page(1))
    assert len(found.jobs(SEARCH)) == 1
    assert waits == [2.0, 4.0, 2.0]
    with pytest.raises(S.StatusError):
        client([S.StatusError(404)])[0].jobs(SEARCH)


def fake_client():
    return S.SearchClient(lambda params, key: page(2), ["k"])


def test_data_source(spark):
    spark.dataSource.register(S.SearchSource)
    rows = spark.read.format("search_api").option("searches", json.dumps([SEARCH, SEARCH | {"query_id": 2}])).option("client", "tests.test_edges:fake_client").load().collect()
    assert sorted(r.query_id for r in rows) == [1, 1, 2, 2]


URL = "https://hooks.slack.com/services/a/b/c"


@pytest.mark.parametrize("bad", ["", "http://hooks.slack.com/services/a/b/c", "https://evil.org/services/a/b/c", URL + "?x=1", URL + "/d", "https://u:p@hooks.slack.com/services/a/b/c", URL + "\n/", "https://hooks.slack.com:x/services/a/b/c"])
def test_webhook_addresses(bad):
    with pytest.raises(N.DeliveryError) as error:
        N.checked_url(bad)
    assert not bad or bad not in str(error.value)


def test_webhook():
    assert N.Webhook(URL).send("x") is False
    assert N.Webhook(URL, True, post=lambda *a: (200, b"ok")).send("x")
    for answer in ((200, b"no"), (500, b"ok")):
        with pytest.raises(N.DeliveryError):
            N.Webhook(URL, True, post=lambda *a, answer=answer: answer).send("x")
    with pytest.raises(N.DeliveryError):
        N.Webhook(URL, True, timeout=11).send("x")


def test_key_ring():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    def limited(text):
        raise E.RateLimited(5.0)

    ring = E.KeyRing([E.Key(limited), E.Key(str.upper)], clock=lambda: now[0], sleep=sleep, jitter=lambda: 0.0)
    assert ring.extract("a") == "A" and ring.extract("b") == "B" and not waits
    failing = E.KeyRing([E.Key(lambda t: (_ for _ in ()).throw(E.Passing()))], clock=lambda: now[0], sleep=sleep, jitter=lambda: 0.0)
    with pytest.raises(E.Passing):
        failing.extract("x")
    assert waits == [5.0, 10.0, 20.0]
    waits.clear()
    paced = E.KeyRing([E.Key(str.upper, since=now[0])], clock=lambda: now[0], sleep=sleep)
    for _ in range(31):
        paced.extract("x")
    assert waits == [60.0]


def test_enrich(spark):
    rows = spark.createDataFrame([("1", "A", "Python, SQL and machine learning; python. Good at C++"), ("2", "A", "nothing"), ("3", "A", "Rust")], "job_id string, data_source string, job_description string")
    got = {r.job_id: r.skills for r in E.enrich(rows).collect()}
    assert got == {"1": "python, sql, machine learning, c++"}


def test_skill_rows_have_a_time(spark):
    rows = spark.createDataFrame([(1, "a", "x", "2026-01-02 03:04:05"), (2, "a", "y", "soon"), (3, "a", "z", None)], "job_id int, data_source string, skills string, created_at string")
    got = E.skill_rows(rows).collect()
    assert [r.job_id for r in got] == ["1", "2", "3"] and str(got[0].created_at) == "2026-01-02 03:04:05"
    assert all(r.created_at.year >= 2024 for r in got)


def test_dispatcher(capsys):
    tasks = {"ok": "tests.test_edges:fine", "bad": "tests.test_edges:broken"}
    assert cli.main(["x", "ok"], {}, tasks) == 0
    assert cli.main(["x"], {"JOB_TASK": "ok"}, tasks) == 0
    assert cli.main(["x", "bad"], {}, tasks) == 1
    assert cli.main(["x", "none"], {}, tasks) == 2
    assert "bad, ok" in capsys.readouterr().err


def fine():
    return None


def broken():
    raise RuntimeError


def test_unknown_method():
    with pytest.raises(ValueError):
        Tokens("x", "like").test("c")


def test_a_budget_for_each_key(spark, tmp_path):
    """Four tasks read candidates, two keys call: each key is one process's, five calls a minute (here: a second)."""

    def key(name):
        def call(text):
            import os
            import time

            with open(f"{tmp_path}/{name}", "a") as out:
                out.write(f"{os.getpid()} {time.time()}\n")
            return "sql"

        return call

    rows = spark.createDataFrame([(str(k), "s", "text") for k in range(40)], "job_id string, data_source string, job_description string").repartition(4)
    got = E.enrich(rows, [key("a"), key("b")], per_minute=5, minute=1.0).collect()
    assert sorted(int(r.job_id) for r in got) == list(range(40))
    calls = {n: [x.split() for x in (tmp_path / n).read_text().splitlines()] for n in ("a", "b")}
    assert sum(map(len, calls.values())) == 40 and min(map(len, calls.values())) > 10
    for made in calls.values():
        assert len({pid for pid, _ in made}) == 1
        times = sorted(float(t) for _, t in made)
        assert all(times[k + 5] - times[k] > 0.5 for k in range(0, len(times) - 5, 5)) and times[-1] - times[0] >= (len(times) - 1) // 5 * 0.9
