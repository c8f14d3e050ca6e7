"""Folders of a running pipeline: consumed files are archived, old ones between stages are let go."""

import os
import time

from tests.rows import at, bag, raw_frame, reading
from wardline.plans.pipeline import fixed_clocks, stored_table
from wardline.sources.json_topics import read_json_folder
from wardline.streaming.pipeline import Staged


def put(spark, folder, n, readings):
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}-{n}.draft"
    with open(draft, "w") as out:
        out.write("\n".join(raw_frame(spark, readings).toJSON().collect()) + "\n")
    os.replace(draft, os.path.join(folder, f"{n:04d}.json"))


def test_consumed_files_are_archived_and_old_ones_let_go(spark, tmp_path):
    raw, archive, seen = str(tmp_path / "raw"), str(tmp_path / "archive"), []
    before = spark.conf.get("spark.sql.streaming.fileSink.log.compactInterval")
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        staged = Staged(
            spark, str(tmp_path / "out"), late="keep", null_key="drop", at=fixed_clocks(), retention="1s"
        )
        for n in range(4):
            now = [reading(value=str(60 + n), when=at(minutes=m)) for m in (0, n)]
            seen += now
            put(spark, raw, n, now)
            staged.run_through(read_json_folder(spark, raw, archive=archive))
            assert bag(staged.stored.latest()) == bag(stored_table(raw_frame(spark, seen), fixed_clocks()))
            time.sleep(1.2)
    finally:
        spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", before)
    deadline = time.time() + 20  # files are moved beside the batches
    while time.time() < deadline and sum(len(f) for _, _, f in os.walk(archive)) < 3:
        time.sleep(0.2)
    archived = sorted(f for _, _, files in os.walk(archive) for f in files if f.endswith(".json"))
    assert archived[:3] == ["0000.json", "0001.json", "0002.json"]
    assert set(os.listdir(raw)) <= {"0003.json"}
    listed = spark.read.parquet(f"{staged.root}/enriched")
    assert listed.count() < len(seen)  # older files are no longer listed
    assert staged.drop_forgotten() > 0 and staged.drop_forgotten() == 0
    assert listed.count() == spark.read.parquet(f"{staged.root}/enriched").count() > 0
    put(spark, raw, 9, [reading(value="99", when=at(minutes=9))])
    seen.append(reading(value="99", when=at(minutes=9)))
    staged.run_through(read_json_folder(spark, raw, archive=archive))
    assert bag(staged.stored.latest()) == bag(stored_table(raw_frame(spark, seen), fixed_clocks()))
