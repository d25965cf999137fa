"""File discovery, scan, validation and staging load on files written for these tests."""

import json

import pytest

from bazaarlake.sources import files, html, paths

ORDERS = "operations_department"


@pytest.fixture
def root(tmp_path):
    for job in files.INGESTS.values():
        (tmp_path / job.folder).mkdir(exist_ok=True)
    return tmp_path


def write(root, name, text, encoding="utf-8"):
    (root / name).write_bytes(text.encode(encoding))


@pytest.mark.parametrize("delimiter", [",", ";", "\t", "|"])
def test_delimiter(delimiter):
    sample = "\n".join(delimiter.join(["a1", "b 2", "c3", "d"]) for _ in range(4))
    assert files.detect_delimiter(sample) == delimiter


def test_layout_drops_the_mark_and_names_the_index():
    layout = files.csv_layout("x.csv", b"\xef\xbb\xbfA Name,,c\n1,2,3\n")
    assert layout.columns == ("A Name", "_c1", "c")
    assert layout.names == ("a_name", "_c1", "c")


def test_discovery_skips_broken_headers_and_unknown_formats(spark, root):
    folder = root / "enterprise_department"
    write(folder, "good.csv", "merchant_id,creation_date,name,street,state,city,country,contact_number\n")
    write(folder, "broken.csv", "merchant_id,creation_datename,street,state,city,country,contact_number\n")
    write(folder, "notes.doc", "hello")
    write(folder, "empty.csv", "")
    required = files.INGESTS["stg_merchant_data"].required
    valid, skipped = files.discover(spark, str(folder), required)
    assert [v.path.rsplit("/", 1)[1] for v in valid] == ["good.csv"]
    assert len(skipped) == 3


def test_orders_with_defects(spark, root):
    write(
        root / ORDERS,
        "a.csv",
        ",order_id,user_id,estimated arrival,transaction_date\n"
        "0,O1,U1,13days,2021-01-02\n"
        "3,,U2,1days,2021-01-02\n"
        "1,O3,,1days,2021-01-02\n"
        "2,O4,U4,1days,2021-99-99\n"
        ",,,,\n"
        "5,O6,U6,soon,1/2/21\n"
        "6,O7,U7,7days,1/2/21\n",
    )
    write(root / ORDERS, "b.csv", "Order ID;User ID;Estimated Arrival;Transaction Date\nO8;U8;1;2021-02-03\n")
    valid, rejected = files.ingest(spark, str(root), "stg_orders", "2024-01-01 00:00:00")
    good = sorted(valid.collect())
    assert [(r.order_id, str(r.transaction_date), r.source_filename) for r in good] == [
        ("O1", "2021-01-02", "a.csv"),
        ("O7", "2021-01-02", "a.csv"),
        ("O8", "2021-02-03", "b.csv"),
    ]
    reasons = {r.order_id: r.reject_reason for r in rejected.filter("order_id is not null").collect()}
    assert reasons == {
        "O3": "user_id: string",
        "O4": "transaction_date: datetime",
        "O6": "estimated_arrival: numeric",
    }
    assert rejected.count() == 5
    positions = [r.ingest_ordinal for r in valid.filter("source_filename = 'a.csv'").orderBy("order_id").collect()]
    assert positions == sorted(positions) and len(set(positions)) == 2


def test_tab_file_with_quotes(spark, root):
    write(
        root / "marketing_department",
        "c.csv",
        '\tcampaign_id\tcampaign_name\tcampaign_description\tdiscount\n'
        '0\tC1\tdon\'t\t"say ""hi"" now"\t1pct\n1\tC2\tx\tplain\t10%%\n',
        "utf-8-sig",
    )
    valid, rejected = files.ingest(spark, str(root), "stg_campaign", "2024-01-01 00:00:00")
    found = {r.campaign_id: (r.campaign_description, r.discount) for r in valid.collect()}
    assert found == {"C1": ('say "hi" now', "1pct"), "C2": ("plain", "10%%")}
    assert rejected.count() == 0


def test_json_array_lines_parquet_and_html(spark, root):
    folder = root / "customer_management_department"
    columns = ["user_id", "name", "job_title", "job_level"]
    write(folder, "array.json", json.dumps([dict(zip(columns, "abcd")), dict(zip(columns, "efgh"))]))
    write(folder, "lines.json", json.dumps(dict(zip(columns, "ijkl"))) + "\n")
    cells = "".join(f"<td>{c}</td>" for c in "mnop")
    heads = "".join(f"<th>{c}</th>" for c in columns)
    write(folder, "page.html", f"<table><tr>{heads}</tr><tr>{cells}</tr></table>")
    write(folder, "none.html", "<p>no table</p>")
    spark.createDataFrame([tuple("qrst")], columns).coalesce(1).write.mode("append").parquet(str(folder))
    valid, _ = files.ingest(spark, str(root), "stg_user_job", "2024-01-01 00:00:00")
    assert sorted(r.user_id for r in valid.collect()) == ["a", "e", "i", "m", "q"]


def test_a_bad_date_in_an_unchecked_table_fails_the_load(spark, root):
    write(
        root / "marketing_department",
        "t.csv",
        "transaction_date,campaign_id,order_id,estimated arrival,availed\nsoon,C1,O1,1,1\n",
    )
    valid, _ = files.ingest(spark, str(root), "stg_campaign_transactions", "2024-01-01 00:00:00")
    with pytest.raises(Exception, match="bad date"):
        valid.collect()


def test_staging_is_replaced_by_each_delivery(spark, root, tmp_path):
    target = str(tmp_path / "staging")
    for user in ["U1", "U2"]:
        write(root / ORDERS, "o.csv", f"order_id,user_id,estimated arrival,transaction_date\nO1,{user},1,2021-01-02\n")
        files.load_staging(spark, str(root), target, "2024-01-01 00:00:00")
        spark.catalog.clearCache()
    assert [r.user_id for r in files.read_staging(spark, target)["stg_orders"].collect()] == ["U2"]


def test_html_first_table():
    page = "<h1>x</h1><table><tr><td>1<td>a &amp; b</tr><tr><td>2</td></tr></table><table><tr><td>9</td></tr></table>"
    assert html.first_table(page) == (["0", "1"], [["1", "a & b"], ["2"]])
    assert html.first_table("<p>none</p>") is None


def test_missing_table_fails_or_is_skipped(spark):
    pages = spark.createDataFrame([("p", "<p>none</p>")], "source string, html string")
    assert html.table_rows(pages, missing="skip").count() == 0
    with pytest.raises(Exception, match="no table"):
        html.table_rows(pages).collect()


def test_required_columns(spark):
    with pytest.raises(KeyError):
        files.require(spark.range(1), ["id", "name"])


def test_paths(spark, tmp_path):
    paths.write_text(spark, str(tmp_path / "x.txt"), "hello")
    assert paths.read_text(spark, str(tmp_path / "x.txt")) == "hello"
    assert paths.files_in(spark, str(tmp_path / "nothing")) == []
