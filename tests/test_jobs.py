import datetime as dt
import os

from refinery.plans import jobs
from refinery.sources import readers


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


SALES = ("id,sale_date,amount,product,client_id,seq\n"
         "1,2024-01-05,10.00, laptop ,C1,0\n"
         "1,2024-01-05,12.00, laptop ,C1,1\n"
         "2,2024-01-06,-5, mouse ,C2,0\n"
         ",2024-01-06,7.00,pen,C2,0\n"
         "3,n/a,8.50,,C9,0\n"
         "4,2024-02-01,3.00,cable,,0\n")
CUSTOMERS = ("id,last_name,first_name,email,phone,birth_date,signup_date,segment,region,active,postcode\n"
             "C1, dupont ,jEAN,Jean@Mail.com,06 12 34,1990-05-15,2020-01-10,premium,idf,oui,75001\n"
             "C2,martin,marie,bad@x.co.uk,+33 6 98,2010-01-01,2023-06-01,,rhone,no,69001\n"
             "C3,bernard,pierre,p@b.fr,0634,,2023-12-01,standard,,,13001\n")


def test_run_day_end_to_end(spark, tmp):
    write(f"{tmp}/sources/sales/sales.csv", SALES)
    write(f"{tmp}/sources/customers/customers.csv", CUSTOMERS)
    status = jobs.run_day(spark, tmp, "2024-02-02", "2024-02-02T06:00:00", "2024-02-02",
                          now=dt.datetime(2024, 2, 2))
    rows = {(r["stage"], r["entity"]): r for r in status.collect()}
    assert rows[("build", "customers")]["rows"] == 2  # C2 is under 18
    assert rows[("build", "sales")]["rows"] == 3  # id 1 (latest copy), 3, 4
    assert rows[("compaction", "sales")]["status"] == "UNCHANGED"  # one file a day folder already
    sales = {r["id"]: r for r in readers.read_curated(spark, f"{tmp}/curated/sales", jobs.SALES_PARTITIONS).collect()}
    assert sales["1"]["amount"] == 12.0 and sales["1"]["segment"] == "PREMIUM" and sales["1"]["region"] == "IDF"
    assert sales["1"]["product"] == "LAPTOP" and sales["1"]["total_ttc"] == 14.4
    assert sales["3"]["product"] == "INCONNU" and sales["3"]["year"] is None and sales["3"]["segment"] is None
    assert sales["4"]["client_id"] == "UNKNOWN" and sales["4"]["month"] == "02"
    cust = {r["id"]: r for r in readers.read_curated(spark, f"{tmp}/curated/customers",
                                                      jobs.CUSTOMERS_PARTITIONS).collect()}
    assert len(cust["C1"]["email"]) == 64 and cust["C3"]["age_band"] == "65+" and cust["C3"]["region"] == "INCONNU"
    assert cust["C3"]["active"] is True and cust["C1"]["loyalty"] == "GOLD"
    reports = spark.read.json(f"{tmp}/reports")
    assert reports.count() == 4
    assert spark.read.json(f"{tmp}/alerts").first()["severity"] == "INFO"


def test_check_quality_on_missing_input_writes_empty_report(spark, tmp):
    out = jobs.check_quality(spark, tmp, "curated", "sales", "2024-02-02", "2024-02-02", "2024-02-02T06:00:00")
    assert out.count() == 0
    rep = spark.read.json(f"{tmp}/reports").first()
    assert rep["global_assessment"]["global_score"] == 0.0 and rep["global_assessment"]["global_status"] == "CRITICAL"
