"""P1 conversion report: the hand fixture of FIXTURES.md and the bucket rules."""
import datetime as dt

from pyspark.sql import Row

from recsmith.plans.conversion import conversion_by_user, conversion_report

D = dt.date(2024, 1, 5)


def _log(spark, rows):
    base = dict(scene="s", os="all", day=D)
    out = []
    for i, (action, user, item, alg) in enumerate(rows):
        out.append(Row(event_id=i, scene=base["scene"], action=action, user=user, item=item, alg=alg,
                       ts=dt.datetime(2024, 1, 5, 10, 0, i), day=D, os="android"))
    return spark.createDataFrame(out)


FIXTURE = [("recommendclick", 7, 1, "a"), ("recommendclick", 7, 1, "b"), ("recommendclick", 7, 2, "b"),
           ("subscribe", 7, 1, None), ("subscribe", 7, 3, None), ("recommendclick", 8, 1, "x:y")]


def test_hand_fixture(spark):
    r = conversion_report(_log(spark, FIXTURE), scene="s", day=D)
    got = {x.alg: (x.subs, x.clicks, x.rate) for x in r.collect()}
    assert got == {"a": (1, 1, 1.0), "b": (0, 2, 0.0)}


def test_per_user(spark):
    r = conversion_by_user(_log(spark, FIXTURE), scene="s", day=D)
    got = sorted((x.user, x.alg, x.subs, x.clicks) for x in r.collect())
    assert got == [(7, "a", 1, 1), (7, "b", 0, 2)]


def test_buckets_and_os(spark):
    rows = [("recommendclick", 9, 1, "a"), ("recommendclick", 14, 1, "a"), ("subscribe", 9, 1, None),
            ("recommendclick", 0, 1, "a")]
    r = conversion_report(_log(spark, rows), scene="s", day=D, n_buckets=8)
    got = {x.alg: (x.subs, x.clicks) for x in r.collect()}
    # 9 % 8 = 1 -> a_1; 14 % 8 = 6 -> unchanged; user 0 is not bucketed
    assert got == {"a_1": (1, 1), "a": (0, 2)}
    assert conversion_report(_log(spark, rows), scene="s", os="IPHONE").count() == 0
    assert conversion_report(_log(spark, rows), scene="s", os="Android").collect()[0].clicks == 3


def test_require_click_first(spark):
    rows = [("subscribe", 7, 1, None), ("recommendclick", 7, 1, "a")]
    loose = conversion_report(_log(spark, rows), scene="s").collect()[0]
    strict = conversion_report(_log(spark, rows), scene="s", require_click_first=True).collect()[0]
    assert (loose.subs, strict.subs) == (1, 0)


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest

    from recsmith import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def test_a_stage_is_made_when_asked_for_and_once():
    from recsmith.session import Stages
    made = []
    st = Stages(a=lambda s: made.append("a") or 1, b=lambda s: made.append("b") or s["a"] + 1, c=lambda s: made.append("c"))
    assert st["b"] == 2 and st["b"] == 2 and made == ["b", "a"] or made == ["a", "b"]
