import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from roadsight.session import get_spark
    s = get_spark("local[*]", 8)
    # tests own the checkpoint location; clusters set spark.checkpoint.dir
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roadsight-test-ckpt-"))
    yield s


def traffic_df(spark, rows):
    """rows: (action_time, monitor_id, car, speed[, seq]) → traffic frame with seq."""
    full = []
    for i, r in enumerate(rows):
        t, m, car, sp = r[:4]
        seq = r[4] if len(r) > 4 else i
        full.append((t, m, f"cam{i:05d}", car, float(sp), "001", "01", seq))
    return spark.createDataFrame(full, "action_time long, monitor_id string, camera_id string, car string, "
                                       "speed double, road_id string, area_id string, seq long")
