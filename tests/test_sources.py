import json
from pathlib import Path

from pyspark.sql import functions as F

from reviewloom.operators.keys import load_profile
from reviewloom.operators.lookup import PATTERN_ORDER, load_lookup
from reviewloom.schemas import LISTING_COLUMNS, REVIEW_RAW
from reviewloom.sources.files import read_by_header
from reviewloom.sources.landing import fractional_ratings, read_landing, to_review_raw
from reviewloom.sources.listing import prepare_listing, read_listing

URL = "https://h/gp/customer-reviews/{}/ref=cm"


def write(folder, name, *lines):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_landing_csv(spark, folder):
    write(folder, "B01-US-Reviews.csv", "Title,Content,URL,Rating,Helpful,Date", f'Good,"<b>it</b>, ""works""",{URL.format("R1")},5,3,2024-03-01', f",,{URL.format('R2')},abc,x,n/a")
    write(folder, "deep/B02-US.csv", "Rating,URL,Content,Title,Vine Voice", f"4.5,{URL.format('R1')},c,t,Y", "3,,c,t,")
    write(folder, "B03-bad.csv", "Title,Content,Rating", "t,c,1")
    write(folder, "B04-US.CSV", "Title,Content,URL,Rating", f"t,c,{URL.format('R9')},1")
    rows, rejects = read_landing(spark, folder)
    raw = to_review_raw(rows)
    got = {(r["ASIN"], r["Review_ID"]): r for r in raw.collect()}
    assert set(got) == {("B01", "R1"), ("B01", "R2"), ("B02", "R1"), ("B02", "")}
    first = got["B01", "R1"]
    assert (first["Review_Key"], first["Rating"], first["Helpful_Votes"], first["Clean_Text"]) == ("B01_R1", 5, 3, 'Good it , "works"')
    assert str(first["Review_Date"]) == "2024-03-01" and first["Vine"] is None and first["Verified"] is None
    second = got["B01", "R2"]
    assert (second["Rating"], second["Helpful_Votes"], second["Review_Date"], second["Clean_Text"]) == (None, 0, None, "")
    third = got["B02", "R1"]
    assert (third["Rating"], third["Helpful_Votes"], third["Vine"], third["Clean_Text"]) == (None, 0, "Y", "t c")
    assert [(r["Source_File"].rsplit("/", 1)[-1], r["missing"]) for r in rejects.collect()] == [("B03-bad.csv", ["URL"])]
    assert [f.dataType.simpleString() for f in raw.schema] == [c.split()[-1].lower() for c in REVIEW_RAW.split(", ")]
    assert [r["rows"] for r in fractional_ratings(rows).collect()] == [1]


def test_multiline_csv_and_json_agree(spark, folder):
    text = 'two\nlines, "quoted"'
    quoted = text.replace('"', '""')
    write(folder, "c/A1-x.csv", "Title,Content,URL,Rating", f't,"{quoted}",{URL.format("R1")},5')
    write(folder, "j/A1-x.json", json.dumps({"Rating": 5, "Title": "t", "URL": URL.format("R1"), "Content": text}))
    kept = ["Title", "Content", "URL", "Rating"]
    a, _ = read_landing(spark, f"{folder}/c", "csv", multiline=True)
    b, _ = read_landing(spark, f"{folder}/j", "json")
    assert a.select(kept).collect() == b.select(kept).collect() == [("t", text, URL.format("R1"), "5")]


def test_parquet_landing(spark, folder):
    path = f"{folder}/p"
    spark.createDataFrame([("t", "c", URL.format("R1"), 4)], "Title string, Content string, URL string, Rating int").write.parquet(path)
    rows, rejects = read_landing(spark, path, "parquet")
    assert to_review_raw(rows).first()["Rating"] == 4 and rejects.count() == 0


def test_empty_folder_is_no_error(spark, folder):
    rows, rejects = read_landing(spark, folder)
    assert rows is None and rejects.count() == 0


def test_json_columns_are_found_in_any_record(spark, folder):
    """Records without a value leave the key out, also the first record of a file."""
    first = {"Title": "t", "URL": URL.format("R1"), "Rating": 5}
    write(folder, "A1-x.json", json.dumps(first), json.dumps({**first, "Content": "c", "Date": "2024-03-01"}))
    write(folder, "A2-x.json", json.dumps({"Title": "t", "Rating": 1}))
    rows, rejects = read_landing(spark, folder, "json")
    got = sorted((r["Clean_Text"], str(r["Review_Date"])) for r in to_review_raw(rows).collect())
    assert got == [("t", "None"), ("t c", "2024-03-01")]
    assert [r["missing"] for r in rejects.collect()] == [["Content", "URL"]]
    empty = Path(folder, "none")
    empty.mkdir()
    assert read_landing(spark, str(empty), "json")[0] is None


def test_load_profile(spark):
    profile, sample = load_profile(spark.range(10))
    assert [tuple(r) for r in profile.collect()] == [("id", "bigint", 10, 0)] and sample.count() == 3


def test_rows_by_header(spark, folder):
    write(folder, "a.csv", "x,y", "1,2")
    write(folder, "b.csv", "y,z", "3,4")
    rows, _ = read_by_header(spark, folder, "csv", ["x", "y"])
    assert sorted(tuple(r) for r in rows.select(F.coalesce("x", F.lit("-")), "y").collect()) == [("-", "3"), ("1", "2")]


def test_listing_export(spark, folder):
    heads = {name: source for source, name, _ in LISTING_COLUMNS}
    assert len(LISTING_COLUMNS) == 54
    columns = ["asin", "brand", "title", "bullets", "parent_asin", "monthly_units", "price", "sub_rank", "review_rate", "listing_date"]
    head = ",".join(heads[c] for c in columns)
    write(folder, "US(Mask)-2024.csv", head, "A1,B,LED Mask,Far Infrared,P,10,49.99,#N/A,12%,2023-01-05", "A2,B,Panel,,P,,60,7,5%,", "A3,,Red Light Panel,,P,1,,7,,")
    write(folder, "US(Cervical).csv", head, "A4,B,neck panel,infrared,Q,3,300,1,1%,2024-01-01")
    raw = read_listing(spark, folder)
    lookup = load_lookup(
        spark.createDataFrame([("Mask", "PANEL", "panel", "2"), ("Mask", "led", "led", "1"), ("Cervical", "panel", "neck", "1")], "Product string, Term string, Type string, Priority string"),
        PATTERN_ORDER,
    )
    rows = {r["asin"]: r for r in prepare_listing(raw, lookup, lookup, lookup).collect()}
    assert set(rows) == {"A1", "A3", "A4"}
    one = rows["A1"]
    assert (one["product"], one["title_bullets"], one["is_infrared"], one["cat"], one["parts"], one["pattern"]) == ("Mask", "led mask;far infrared", "FIR", "led", "led", "led")
    assert one["price_band"].startswith("a.") and one["sub_rank"] is None and one["review_rate"] == 0.12 and str(one["listing_date"]) == "2023-01-05"
    assert rows["A3"]["price_band"] is None and rows["A3"]["is_infrared"] == "RLT" and rows["A3"]["title_bullets"] == "red light panel"
    assert rows["A4"]["parts"] == "肩颈部" and rows["A4"]["pattern"] == "neck" and rows["A4"]["is_infrared"] == "Infrared_Only"


def test_names_with_blanks_brackets_and_other_scripts(spark, folder):
    names = ["US(Red Light)-2024.csv", "US(肩颈)-2024.csv", "A+B 100%[x].csv", "plain-{1}.csv"]
    for i, name in enumerate(names):
        write(folder, name, "Title,Content,URL,Rating", f"t{i},c,{URL.format(f'R{i}')},{i}")
    rows, rejects = read_landing(spark, folder)
    got = {r["Title"]: r["Source_File"].rsplit("/", 1)[-1] for r in rows.collect()}
    assert got == {f"t{i}": name for i, name in enumerate(names)} and rejects.count() == 0
    listing = LISTING_COLUMNS[0][0]
    write(f"{folder}/l", "US(肩 颈)-2024.csv", listing, "x")
    assert [r["product"] for r in read_listing(spark, f"{folder}/l").collect()] == ["肩 颈"]


def test_a_bad_file_is_a_reject_and_the_others_load(spark, folder):
    write(folder, "c/good.csv", "Title,Content,URL,Rating", f"t,c,{URL.format('R1')},1")
    write(folder, "c/twice.csv", "Title,Content,URL,Rating,title", f"t,c,{URL.format('R2')},1,u")
    Path(f"{folder}/c/odd.csv").write_bytes(b"\xff\xfe\x00T\x00i\n\xc3\x28,1\n")
    rows, rejects = read_landing(spark, f"{folder}/c")
    assert [r["Title"] for r in rows.collect()] == ["t"]
    reasons = {r["Source_File"].rsplit("/", 1)[-1]: r["reason"] for r in rejects.collect()}
    assert reasons["odd.csv"] == "missing columns" and reasons["twice.csv"].startswith("repeated columns") and len(reasons) == 2

    ddl = "Title string, Content string, URL string, Rating {}"
    spark.createDataFrame([("a", "c", URL.format("R1"), 4)], ddl.format("bigint")).coalesce(1).write.parquet(f"{folder}/p/one")
    spark.createDataFrame([("b", "c", URL.format("R2"), "5")], ddl.format("string")).coalesce(1).write.parquet(f"{folder}/p/two")
    Path(f"{folder}/p/broken.parquet").write_bytes(b"not parquet at all")
    rows, rejects = read_landing(spark, f"{folder}/p", "parquet")
    assert sorted((r["Title"], r["Rating"]) for r in rows.collect()) == [("a", "4"), ("b", "5")]
    assert [r["reason"].split(":")[0] for r in rejects.collect()] == ["unreadable"]


def test_json_listing(spark, folder):
    source, name, _ = LISTING_COLUMNS[0]
    write(folder, "US(Neck)-1.json", json.dumps({source: "x"}))
    got = read_listing(spark, folder, "json").collect()
    assert [(r["product"], r[name]) for r in got] == [("Neck", "x")]
