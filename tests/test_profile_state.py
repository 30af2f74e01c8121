import random

import pytest

from threadloom.operators import profile as P
from threadloom.operators import profile_state as PS

SCHEMA = "tweet_id string, author_id string, inbound boolean, text string, in_response_to_tweet_id string, extra int"


def messages(seed, n=400):
    rng = random.Random(seed)
    words = ["late", "lost", "refund", "Parcel", "hi", "it\u2019s", ""]
    rows = []
    for i in range(n):
        text = rng.choice([None, " ".join(rng.choices(words, k=rng.randint(0, 8)))])
        inbound = rng.choice([True, False, False, None])
        author = "c" + str(i % 20) if inbound else "shop" + str(rng.choice([0, 0, 0, 1, 2]))
        parent = rng.choice([None, f"m{rng.randrange(n)}", f"m{rng.randrange(n)}", "gone"])
        rows.append((f"m{i}", author, inbound, text, parent, i))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_days_add_up_to_the_profile_of_all_messages(spark, tmp_path, seed):
    rows = messages(seed)
    whole = spark.createDataFrame(rows, SCHEMA)
    want = sorted(P.profile_accounts(whole, 1.0, 1).collect())
    assert len(want) == 3
    random.Random(seed).shuffle(rows)
    log = PS.open_log(spark, str(tmp_path / "state"))
    for day in range(3):
        mine = rows[day::3] + (rows[:40] if day else [])  # delivered again
        PS.add_day(log, spark.createDataFrame(mine, SCHEMA), f"day-{day}")
        PS.add_day(log, whole, f"day-{day}")  # the day is committed: nothing happens
        if day == 1:
            PS.merge_days(log)
            assert log.runs() == ["merged-00000000"] and log.committed("day-0")
    assert sorted(PS.profile(log, 1.0, 1).collect()) == want
    PS.merge_days(log)
    assert sorted(PS.profile(log, 1.0, 1).collect()) == want


def test_a_profile_reads_no_messages(spark, tmp_path):
    log = PS.open_log(spark, str(tmp_path / "state"))
    with pytest.raises(ValueError):
        PS.profile(log)
    PS.add_day(log, spark.createDataFrame(messages(3, 50), SCHEMA), "a")
    assert "text" not in log.read().columns
    PS.add_day(log, spark.createDataFrame([], SCHEMA), "b")
    assert log.runs() == ["a", "b"]
