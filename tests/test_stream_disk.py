"""What the scoring stream keeps on disk: batches of files, compressed lines, nothing on the way."""
import json
import os

from pyspark.sql import functions as F

from cohort_spark.streaming import queries as Q
from tests.test_requests import Model, good


def files(top):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(top) for f in fs if not f.startswith((".", "_")))


def test_lines_go_by_batches_and_leave_only_outputs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "LINES_PER_FILE", 2)
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    lines = [good(request_id=f"a{i}") for i in range(4)] + [good(request_id="b", time_in_hospital="abc"), "{broken"]
    Q.write_request_files(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), source)
    assert len(files(source)) == 3 and all(f.endswith(".gz") for f in files(source))
    on_the_way = []

    class Watched(Q.ScoringSink):
        def write_scored(self, judged, batch_id):
            on_the_way.extend(judged.select("accepted", F.col("value").isNull(), F.col("inputs").isNull()).collect())
            super().write_scored(judged, batch_id)

    Q.scoring_stream(spark, source, Q.Scoring(Model(), 0.5), sink, of=Watched, files=1, consume=True)[0].awaitTermination()
    assert sorted(os.listdir(f"{sink}/scored")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert files(f"{sink}/_work") == [] and len(files(source)) < 3
    assert all(f.endswith(".gz") for f in files(f"{sink}/audit"))
    # a line is kept with its refusal only, its fields with what is audited only
    assert len(on_the_way) == 6 and all(r[0] == r[1] and r[0] != r[2] for r in on_the_way)
    assert sorted(r.request_id for r in spark.read.parquet(f"{sink}/scored").collect()) == ["a0", "a1", "a2", "a3"]
    assert sorted(json.loads(r.value)["request_id"] for r in spark.read.text(f"{sink}/audit").collect()) == ["a0", "a1", "a2", "a3"]
    assert sorted(r.value for r in spark.read.parquet(f"{sink}/rejected").collect()) == sorted(lines[4:])
