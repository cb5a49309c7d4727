"""Layer jobs end to end from CSV files: ingest -> keyed silver -> gold."""

import os

from stratum.plans import jobs as J
from stratum.sources.tables import Layout

HEADER = ("batch_id,lot_id,test_id,test_name,test_value,unit,lower_spec,upper_spec,result_flag,"
          "analyst_id,test_date\n")


def _write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_csv_to_gold(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "incoming")
    os.makedirs(src)
    lay = Layout(os.path.join(tmpdir_path, "lake"))
    _write(f"{src}/day1.csv", HEADER
           + "1,10,1-1,pH,7.0, mg ,5,45,Pass,AN_1,2024-01-02 10:00:00\n"
           + "1,11,1-2,Sterility,8.0, mg ,5,45,fail,AN_1,2024-01-02 11:00:00\n"
           + "2,12,2-1,Viscosity,9.0,,5,45,,AN_2,2024-01-03 09:00:00\n")
    J.bronze_job(spark, lay, "qc_lab_result", src)
    J.silver_job(spark, lay, "qc_lab_result")
    J.gold_job(spark, lay, "qc_summary")
    gold = {r.test_name: r for r in spark.read.parquet(lay.gold("qc_summary")).collect()}
    assert gold["PH"].pass_count == 1 and gold["STERILITY"].fail_count == 1
    assert gold["UNKNOWN"].total_tests == 1              # Viscosity is not a listed test

    # day 2 re-delivers (lot 11, test 1-2) as a pass and adds a new test
    _write(f"{src}/day2.csv", HEADER
           + "1,11,1-2,Sterility,8.5, mg ,5,45,PASS,AN_1,2024-01-04 11:00:00\n"
           + "3,13,3-1,Potency,6.0, mg ,5,45,Pass,AN_3,2024-01-05 08:00:00\n")
    J.bronze_job(spark, lay, "qc_lab_result", src)
    J.silver_job(spark, lay, "qc_lab_result")
    J.gold_job(spark, lay, "qc_summary")
    silver = spark.read.parquet(lay.silver("qc_lab_result"))
    assert silver.count() == 4
    row = silver.filter("lot_id = 11").first()
    assert row.result_flag == "PASS" and row.test_value == 8.5 and row["__batch"] == 1
    gold = {r.test_name: r for r in spark.read.parquet(lay.gold("qc_summary")).collect()}
    assert gold["STERILITY"].pass_count == 1 and gold["STERILITY"].fail_count == 0
    assert gold["POTENCY"].total_tests == 1
