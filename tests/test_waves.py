"""Scoring that dies midway and is called again, and batches that fail."""

import pytest

from tracklens import operators as ops
from tracklens import plans
from tracklens.operators.scoring import _tried


def test_finished_waves_are_not_scored_again(spark, tmp_path):
    calls, died = tmp_path / "calls", tmp_path / "died"
    df = spark.range(60).toDF("track_id")
    fatal = df.where("track_id <> 11 and pmod(xxhash64(track_id), 6) = 3").first()["track_id"]

    def make_scorer():
        def score(row):
            with open(calls, "a") as log:
                log.write(f"{row['track_id']}\n")
            if row["track_id"] == fatal and not died.exists():
                died.touch()
                raise SystemExit("killed")
            if row["track_id"] == 11:
                raise ValueError("no audio")
            return {"size": row["track_id"] * 2}

        return score

    folder = str(tmp_path / "scored")

    def run():
        return plans.score_in_waves(df, ops.row_by_row(make_scorer), "size long", folder, waves=6)

    with pytest.raises(Exception, match="killed|SystemExit|crashed"):
        run()
    before = calls.read_text().split()
    assert 0 < len(before) < 60
    got = {r.track_id: (r.size, r.error) for r in run().collect()}
    assert len(got) == 60 and got[11] == (None, "ValueError: no audio")
    assert all(got[i] == (2 * i, None) for i in range(60) if i != 11)
    again = calls.read_text().split()[len(before) :]
    # The wave that died is scored anew, those before it are not.
    assert str(fatal) in again and len(again) < 60 and len(set(before) | set(again)) == 60
    run().collect()
    assert len(calls.read_text().split()) == len(before) + len(again)


def test_a_failing_batch_is_halved():
    asked = []

    def scorer(records):
        asked.append(len(records))
        if any(r["x"] == 700 for r in records):
            raise ValueError("bad")
        return [{"y": r["x"]} for r in records]

    found = _tried(scorer, [{"x": i} for i in range(1024)])
    assert [i for i, f in enumerate(found) if isinstance(f, Exception)] == [700]
    assert all(f == {"y": i} for i, f in enumerate(found) if i != 700)
    assert len(asked) == 21 and max(asked) == 1024
