"""The sample sheet by literal cases."""

import pytest

from tidewater.sources import metadata

HEAD = "Extra\tSample_ID\tPipeline_ID\tReplicate\tWell\tPlate\tRun\tdemult_id\r\n"


def _sheet(spark, tmp_path, *rows):
    (tmp_path / "m.tsv").write_text(HEAD + "".join("\t".join(x) + "\r\n" for x in rows))
    return metadata.read_metadata(spark, str(tmp_path / "m.tsv"))


def test_rows_of_a_run(spark, tmp_path):
    good = ("e", "s1", "p1", "r1", "A1", "P1", "run", ">A1_P1")
    sheet = _sheet(spark, tmp_path, good, ("", "", "", "", "", "", "other", ""), ("short",))
    assert [(r.line, r.Sample_ID, r.well_plate, r.unit) for r in metadata.select_run(sheet, "run").collect()] == [(2, "s1", "A1_P1", "r1_A1_P1")]
    assert metadata.select_run(sheet, "none").count() == 0
    bad = _sheet(spark, tmp_path, good, ("", "no_adapter", "a|b", "r 1", "A1", "", "run", ">A1_P1"))
    found = [r.problems for r in metadata.select_run(bad, "run", strict=False).orderBy("line").collect()]
    assert found == ["", "Plate is empty; Replicate must not contain whitespace or _; Sample_ID must not use reserved no_adapter identity; Pipeline_ID must not contain |; demult_id must equal >A1_"]
    with pytest.raises(Exception, match="Plate is empty"):
        metadata.select_run(bad, "run").collect()


def test_missing_columns(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("Sample_ID\tRun\n")
    with pytest.raises(ValueError, match="Pipeline_ID, Replicate"):
        metadata.read_metadata(spark, str(tmp_path / "m.tsv"))
