"""The 46-column incident file: schema, names and a round trip through the given tables."""

import json

from pyspark.sql import functions as F

from sevlens.functions.features import incident_feature_columns
from sevlens.plans import incidents as inc
from sevlens.sources import files, incident_csv

SMALL = "/root/testdata/sf0.001"


def test_schema_has_46_columns_and_survives_json():
    assert len(incident_csv.RAW_SCHEMA.names) == 46 and set(incident_csv.CLEAN_NAMES) <= set(incident_csv.RAW_SCHEMA.names)
    assert files.schema_from_json(json.dumps(incident_csv.RAW_SCHEMA.jsonValue())) == incident_csv.RAW_SCHEMA


def test_round_trip_under_the_raw_names(spark, tmp_path):
    own = inc.raw_incidents(spark, SMALL)
    known = {c: F.col(c) for c in own.columns}
    types = {incident_csv.CLEAN_NAMES.get(f.name, f.name): f.dataType for f in incident_csv.RAW_SCHEMA}
    wide = own.select(*[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])
    path = files.write_csv(incident_csv.raw_names(wide), str(tmp_path / "raw"))
    back = incident_csv.read_incident_csv(spark, path)
    assert back.columns == wide.columns
    assert back.exceptAll(wide).count() == 0 and back.count() == own.count()
    assert back.withColumns(incident_feature_columns()).count() == own.count()
    good, bad = files.split_corrupt(incident_csv.read_incident_csv(spark, path, keep_corrupt=True))
    assert good.count() == own.count() and bad.count() == 0
