"""The reference's pipeline end to end on tiny files in its own input formats."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from daybook import schemas
from daybook.plans import questions, stages
from daybook.sources import readers, sinks
from tests.conftest import rows

D = dt.date

CASES = """{"total_rows":5,"offset":0,"rows":[
{"id":"1","value":{"report_time":"2020-01-30T13:33:00.00+05:30","state":"kl","confirmed_india":1,"confirmed_foreign":0,"cured":0,"death":1,"confirmed":1}},
{"id":"2","value":{"report_time":"2020-01-31T10:00:00.00+05:30","state":"kl","confirmed_india":2,"confirmed_foreign":0,"cured":1,"death":2,"confirmed":2}},
{"id":"3","value":{"report_time":"2020-01-30T10:00:00.00+05:30","state":"dn_dd","confirmed_india":3,"confirmed_foreign":0,"cured":0,"death":3,"confirmed":3}},
{"id":"4","value":{"report_time":"2020-01-31T10:00:00.00+05:30","state":"ga","confirmed_india":1,"confirmed_foreign":0,"cured":0,"death":1,"confirmed":1}},
{"id":"5","value":{"report_time":"2020-01-31T10:00:00.00+05:30","state":"zz","confirmed_india":9,"confirmed_foreign":0,"cured":0,"death":9,"confirmed":9}}
]}
"""

CODES = """Subdivision category,3166-2 code,Subdivision name
state,IN-KL,Kerala
Union territory,IN-DH,Dadra and Nagar Haveli and Daman and Diu
state,IN-GA,Go
state,IN-GA,Goa
"""

CITIES = 'Name of City,State\r\nNoida,Kerala\r\nGaya,Goa\r\n"Shahabad, Hardoi",Goa\r\nHardoi ,Goa\r\n'

AIR = """location,city,country,pollutant,value,timestamp,unit,source_name,latitude,longitude,averaged_over_in_hours,location_geom
"Sector-62, Noida - UPPCB",Noida,IN,co,1.0,2020-01-30 10:00:00,ppm,s,0,0,1,g
"Sector-62, Noida - UPPCB",Noida,IN,co,3.0,2020-01-30 12:00:00,ppm,s,0,0,1,g
"Sector-62, Noida - UPPCB",Noida,IN,pm25,50.0,2020-01-31 12:00:00,ugm3,s,0,0,1,g
"Sector-1, Gaya - BSPCB",Gaya,IN,pm25,10.125,2020-01-31 12:00:00,ugm3,s,0,0,1,g
"Far - Away - X",Other,US,co,99.0,2020-01-30 12:00:00,ppm,s,0,0,1,g
"""

CLOSES = {
    "close_nifty_50": "Date,Open,High,Low,Close\n30 Jan 2020,1,1,1,100.5\n",
    "close_nifty_500": "Date,Open,High,Low,Close\n30 Jan 2020,1,1,1,-\n",
    "close_nifty_healthcare": "Date,Open,High,Low,Close\n30 Jan 2020,1,1,1,7\n",
    "close_nifty_IT": "Date,Open,High,Low,Close\n30 Jan 2020,1,1,1,8\n",
    "close_nifty_pharma": "Date,Open,High,Low,Close\n30 Jan 2020,1,1,1,9\n",
}


@pytest.fixture(scope="module")
def inputs(spark):
    d = tempfile.mkdtemp(prefix="daybook-test-")

    def put(name, text):
        p = os.path.join(d, name)
        with open(p, "w", newline="") as fh:
            fh.write(text)
        return p

    cases = readers.read_json_records(spark, put("cases.json", CASES))
    codes = readers.read_csv(spark, put("codes.csv", CODES), schemas.REGION_CODES)
    cities = readers.read_csv(spark, put("cities.csv", CITIES), schemas.CITY_REGION)
    air = readers.read_csv(spark, put("air.csv", AIR), schemas.AIR_QUALITY)
    closes = {k: readers.read_csv(spark, put(f"{k}.csv", v), schemas.INDEX_CLOSES)
              for k, v in CLOSES.items()}
    vacc_rows = spark.createDataFrame([
        (D(2020, 1, 30), "Kerala", 10, 20), (D(2020, 1, 31), "Kerala", 11, 21),
        (D(2020, 1, 30), "Dadra & Nagar Haveli", 1, 1), (D(2020, 1, 30), "Daman & Diu", 2, 2),
        (D(2020, 1, 31), "Goa", 5, 5), (D(2020, 2, 1), "Goa", 6, 6),
    ], "day date, region string, dose_1 bigint, total_doses bigint")
    for m in schemas.DOSE_MEASURES:
        if m not in vacc_rows.columns:
            vacc_rows = vacc_rows.withColumn(m, F.lit(0).cast("bigint"))
    return dict(dir=d, cases=cases, codes=codes, cities=cities, air=air, closes=closes,
                vacc=vacc_rows)


def test_json_scan_drops_wrapper_lines(inputs):
    assert inputs["cases"].count() == 5


def test_city_list_csv(inputs):
    names = rows(inputs["cities"], "Name of City")
    assert names == [("Gaya",), ("Hardoi ",), ("Noida",), ("Shahabad, Hardoi",)]


def test_t1_case_table(inputs):
    t1 = stages.case_table(inputs["cases"], inputs["codes"])
    got = rows(t1, "report_time", "state", "state_name", "death")
    assert got == [(D(2020, 1, 30), "dh", "Dadra and Nagar Haveli and Daman and Diu", 3),
                   (D(2020, 1, 30), "kl", "Kerala", 1),
                   (D(2020, 1, 31), "ga", "Goa", 1),
                   (D(2020, 1, 31), "kl", "Kerala", 2),
                   (D(2020, 1, 31), "zz", None, 9)]


def test_n5_region_extremes(inputs):
    t1 = stages.case_table(inputs["cases"], inputs["codes"])
    r = questions.region_extremes(t1).collect()[0]
    # Kerala and Dadra... both have 3 deaths: the tie goes to the first name
    assert (r["max_state_name"], r["max_death"]) == ("Dadra and Nagar Haveli and Daman and Diu", 3)
    assert (r["min_state_name"], r["min_death"]) == ("Goa", 1)
    ranking = [tuple(x) for x in questions.region_totals(t1).collect()]
    assert ranking == [("Dadra and Nagar Haveli and Daman and Diu", 3), ("Kerala", 3),
                       ("Goa", 1)]   # the unnamed code (zz) is not ranked


def pipeline(inputs):
    t1 = stages.case_table(inputs["cases"], inputs["codes"])
    t2 = stages.vaccination_by_region(inputs["vacc"])
    t3 = stages.cases_with_vaccination(t1, t2)
    t4 = stages.station_day(inputs["air"])
    t5 = stages.pollution_by_region(t4, inputs["cities"])
    t6 = stages.combined_region(t3, t5)
    t7 = stages.country_by_day(t6)
    t8 = stages.closes_by_day(inputs["closes"])
    t9 = stages.country_with_closes(t7, t8)
    return dict(t1=t1, t2=t2, t3=t3, t4=t4, t5=t5, t6=t6, t7=t7, t8=t8, t9=t9)


def test_t2_t3_right_join_keeps_vaccination_rows(inputs):
    p = pipeline(inputs)
    t2 = {(r["day"], r["region"]): r["dose_1"] for r in p["t2"].collect()}
    assert t2[(D(2020, 1, 30), "Dadra and Nagar Haveli and Daman and Diu")] == 3
    t3 = p["t3"].collect()
    assert len(t3) == 5
    unmatched = [r for r in t3 if r["report_time"] is None]
    assert len(unmatched) == 1 and unmatched[0]["dose_1"] == 6      # Goa on 1 Feb: no cases


def test_t4_t5_pollution(inputs):
    p = pipeline(inputs)
    t4 = {(r["location"], r["day"]): r for r in p["t4"].collect()}
    assert len(t4) == 3                                              # US station filtered
    r = t4[("Sector-62, Noida - UPPCB", D(2020, 1, 30))]
    assert r["co"] == 2.0 and r["city_refined"] == "Noida" and r["pollution_board"] == "62, Noida"
    t5 = {(r["day"], r["region"]): r for r in p["t5"].collect()}
    # Kerala 30 Jan has co but no pm25: backward fill takes the 31 Jan value
    assert t5[(D(2020, 1, 30), "Kerala")]["pm25"] == 50.0
    assert t5[(D(2020, 1, 31), "Kerala")]["co"] is None             # trailing gap stays
    assert t5[(D(2020, 1, 31), "Goa")]["pm25"] == 10.12              # 10.125 -> half even


def test_t6_to_t9(inputs):
    p = pipeline(inputs)
    t6 = p["t6"].collect()
    assert all(r["report_time"] is not None for r in t6)
    kerala_31 = [r for r in t6 if r["state_name"] == "Kerala" and r["report_time"] == D(2020, 1, 31)]
    assert kerala_31[0]["co"] == 2.0                                 # imputed with Kerala's mean
    t9 = {r["report_time"]: r for r in p["t9"].collect()}
    assert t9[D(2020, 1, 30)]["close_nifty_50"] == 100.5
    assert t9[D(2020, 1, 30)]["close_nifty_500"] is None             # '-' -> null
    assert t9[D(2020, 1, 31)]["close_nifty_50"] == 100.5             # carried forward
    assert t9[D(2020, 1, 31)]["dose_1"] == 11 + 5


def test_questions_shapes(inputs):
    p = pipeline(inputs)
    assert set(questions.index_quarterly(p["t8"]).columns) == {"quarter", "variable", "mean_close"}
    n3 = {r["report_time"]: r for r in questions.doses_and_cases(p["t6"]).collect()}
    assert n3[D(2020, 1, 31)]["mean_total_doses"] == (21 + 5) / 2
    n4 = questions.deaths_per_quarter(p["t6"]).collect()
    assert [r["quarter"] for r in n4] == ["2020Q1"]


def test_csv_sink_roundtrip(spark, inputs):
    p = pipeline(inputs)
    out = os.path.join(inputs["dir"], "t3_out")
    sinks.write_csv(p["t3"], out, sep="|", single_file=True)
    parts = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.option("header", True).option("sep", "|").csv(out)
    assert back.count() == 5 and back.columns == p["t3"].columns


def test_file_date_from_name(spark, inputs):
    d = os.path.join(inputs["dir"], "reports")
    os.makedirs(d, exist_ok=True)
    for name in ("2021-04-02-report.csv", "2021-04-03-report.csv"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("a\n1\n")
    df = readers.with_file_date(spark.read.option("header", True).csv(d))
    assert rows(df, "report_date") == [(D(2021, 4, 2),), (D(2021, 4, 3),)]


def test_run_whole_pipeline_from_files(spark, inputs):
    from daybook.plans.run import run
    d = inputs["dir"]
    f = "2020-01-30.pdf"
    cells = [(f, 420, 0, 0, ["title"]),
             (f, 420, 1, 0, ["S", "State", "D1", "D2", "a", "b", "c", "d", "e", "f", "Total"]),
             (f, 420, 1, 1, ["1", "A & N Islands", "1", "2", "0", "0", "0", "0", "3", "4", "10"]),
             (f, 420, 1, 2, ["2", "Kerala", "1,000", "2,000", "0", "0", "0", "0", "5", "6",
                             "3,011"]),
             (f, 420, 1, 3, ["3", "Goa", "12.5", "0", "0", "0", "0", "0", "0", "0", "0"])]
    reports = os.path.join(d, "reports.parquet")
    spark.createDataFrame(cells, schemas.REPORT_CELLS).write.mode("overwrite").parquet(reports)
    closes = {k: os.path.join(d, f"{k}.csv") for k in CLOSES}
    out = os.path.join(d, "out")
    res = run(spark, os.path.join(d, "cases.json"), os.path.join(d, "codes.csv"), reports,
              os.path.join(d, "air.csv"), os.path.join(d, "cities.csv"), closes, out)
    t2 = {r["region"]: r for r in res["vaccination_region"].collect()}
    assert t2["Kerala"]["dose_1"] == 1000 and t2["Kerala"]["precaution_dose"] == 11
    assert t2["Andaman and Nicobar Islands"]["total_doses"] == 10
    assert sorted(os.listdir(out)) == [
        "ambiguous_cities", "cases_vaccination_region", "combined_region", "country_closes_day", "country_day",
        "pollution_region", "rejected_case_days", "rejected_case_records", "rejected_documents",
        "rejected_report_cells", "rejected_report_rows", "vaccination_region"]
    rejected = res["rejected_report_rows"].collect()
    assert [(r["region"], r["dose_1"], r["rejects"]) for r in rejected] == [("Goa", 0, 1)]
    unread = res["rejected_report_cells"].collect()
    assert [(r["file_name"], r["doc_index"], r["row_index"], r["region"], r["measure"], r["cell"], r["text"])
            for r in unread] == [(f, 420, 3, "Goa", "dose_1", 2, "12.5")]
    t9 = res["country_closes_day"].collect()
    assert [r["dose_1"] for r in t9] == [1000]


def test_closes_from_catalog_tables(spark, inputs):
    from daybook.plans.run import read_closes
    inputs["closes"]["close_nifty_IT"].createOrReplaceTempView("daybook_test_closes_it")
    specs = {k: os.path.join(inputs["dir"], f"{k}.csv") for k in CLOSES}
    specs["close_nifty_IT"] = "table:daybook_test_closes_it"
    t8 = stages.closes_by_day(read_closes(spark, specs))
    r = t8.collect()[0]
    assert r["Date"] == D(2020, 1, 30) and r["close_nifty_IT"] == 8.0 and r["close_nifty_500"] is None
