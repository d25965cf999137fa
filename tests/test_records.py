"""CSV records and JSON objects that go on across lines, braces, blocks and tasks."""

import csv
import io
import json
import random

import pytest

from bazaarlake.sources import files, paths, records

COLUMNS = ["campaign_id", "campaign_name", "campaign_description", "discount"]


@pytest.fixture
def small_blocks(spark):
    """Files are cut every few hundred bytes, so that one file is read by many tasks."""
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def texts(seed, count):
    pick = random.Random(seed)
    marks = ['"', ",", "\n", "\r\n", "x", "long words ", "é", "{", "}", "[", "]", "\\", "\\\\", '""', ";"]
    return ["t" + "".join(pick.choice(marks) for _ in range(pick.randrange(12))) + "." for _ in range(count)]


def as_csv(rows, delimiter=",", header=COLUMNS):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=delimiter, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    return out.getvalue()


def campaigns(spark, root):
    valid, _ = files.ingest(spark, str(root), "stg_campaign", "2024-01-01 00:00:00")
    return valid.orderBy("source_filename", "ingest_ordinal").collect()


@pytest.mark.parametrize("many", [0, 2])
@pytest.mark.parametrize("seed, delimiter, count", [(1, ",", 300), (3, "\t", 3)])
def test_csv_equals_a_reader_that_honours_quotes(
    spark, tmp_path, small_blocks, monkeypatch, seed, delimiter, count, many
):
    monkeypatch.setattr(records, "MANY", many)
    folder = tmp_path / "marketing_department"
    folder.mkdir()
    rows = [[f"C{i}", t, u, f"{i}%"] for i, (t, u) in enumerate(zip(texts(seed, count), texts(seed + 9, count)))]
    (folder / "a b%.csv").write_bytes(as_csv(rows, delimiter).encode())
    (folder / "plain.csv").write_bytes(as_csv([["P1", "n", "d", "1%"]]).encode())
    found = campaigns(spark, tmp_path)
    spread = [r for r in found if r.source_filename != "plain.csv"]
    assert [r.campaign_id for r in spread] == [row[0] for row in rows]
    assert [[r.campaign_id, r.campaign_name, r.campaign_description, r.discount] for r in spread] == rows
    ordinals = [r.ingest_ordinal for r in spread]
    assert len(set(ordinals)) == len(ordinals)
    assert len(found) == len(rows) + 1
    if count == 300:
        lines = records.pieces(spark, [str(folder / "a b%.csv")], "\n")
        assert lines.rdd.getNumPartitions() > 8


def test_quotes_inside_plain_fields_blank_lines_and_marks(spark, tmp_path):
    folder = tmp_path / "marketing_department"
    folder.mkdir()
    text = (
        '﻿"campaign_id",campaign_name,"campaign_\ndescription",discount\r\n'.replace("_\n", "_")
        + 'C1,a 5" pipe,"two\r\nlines",1%\r\n\r\n'
        + 'C2,"say ""hi""\n""",plain,2%\r\n'
        + "C3,short\r\n"
    )
    (folder / "a.csv").write_bytes(text.encode())
    found = [(r.campaign_id, r.campaign_name, r.campaign_description, r.discount) for r in campaigns(spark, tmp_path)]
    assert found == [
        ("C1", 'a 5" pipe', "two\r\nlines", "1%"),
        ("C2", 'say "hi"\n"', "plain", "2%"),
        ("C3", "short", None, None),
    ]


def test_old_line_ends(spark, tmp_path):
    folder = tmp_path / "marketing_department"
    folder.mkdir()
    (folder / "a.csv").write_bytes(as_csv([["C1", "n", "d", "1%"], ["C2", "m", "e", "2%"]]).replace("\n", "\r").encode())
    assert [r.campaign_id for r in campaigns(spark, tmp_path)] == ["C1", "C2"]


def test_files_that_end_inside_a_record_are_passed_over(spark, tmp_path):
    folder = tmp_path / "marketing_department"
    folder.mkdir()
    (folder / "good.csv").write_bytes(as_csv([["C1", "a\nb", "d", "1%"]]).encode())
    (folder / "torn.csv").write_bytes((",".join(COLUMNS) + '\nC2,"never\nends,1%\nC3,x,y,2%\n').encode())
    (folder / "torn.json").write_text('[{"campaign_id": "C4", "campaign_name": "x", "campaign_description": "y", "discount": "1"}, {"a": "')
    valid, skipped = files.discover(spark, str(folder), COLUMNS)
    assert [v.path.rsplit("/", 1)[1] for v in valid] == ["good.csv"]
    assert len(skipped) == 2
    assert [r.campaign_name for r in campaigns(spark, tmp_path)] == ["a\nb"]


@pytest.mark.parametrize("indent, separators", [(None, (",", ":")), (2, None)])
@pytest.mark.parametrize("nested, many", [(False, 0), (True, 0), (True, 2)])
def test_json_arrays(spark, tmp_path, small_blocks, monkeypatch, indent, separators, nested, many):
    monkeypatch.setattr(records, "MANY", many)
    folder = tmp_path / "marketing_department"
    folder.mkdir()
    rows = []
    for i, (t, u) in enumerate(zip(texts(5, 200), texts(6, 200))):
        if not nested:
            t, u = (x.replace("{", "(").replace("}", ")") for x in (t, u))
        row = dict(zip(COLUMNS, [f"C{i}", t, u if i % 7 else None, i + 0.5]))
        if nested:
            row = {"more": {"deep": [{"x": "]}"}, {}]}, **row}
        rows.append(row)
    (folder / "a.json").write_bytes(json.dumps(rows, indent=indent, separators=separators).encode())
    (folder / "none.json").write_text(" [ ] ")
    layouts, skipped = files.discover(spark, str(folder), COLUMNS)
    assert [each.spread for each in layouts] == [nested] and len(skipped) == 1
    found = campaigns(spark, tmp_path)
    assert [[r.campaign_id, r.campaign_name, r.campaign_description, r.discount] for r in found] == [
        [row[c] if c != "discount" else str(row[c]) for c in COLUMNS] for row in rows
    ]
    assert records.pieces(spark, [layouts[0].path], "}").rdd.getNumPartitions() > 8


def test_only_the_start_of_a_json_file_is_read_for_its_names(spark, tmp_path, monkeypatch):
    folder = tmp_path / "f"
    folder.mkdir()
    row = dict(zip(COLUMNS, "abcd"))
    (folder / "a.json").write_text("\n".join([json.dumps(row)] * 5000))
    late = [{c: "x" for c in COLUMNS[:3]}] * 3000 + [row]
    (folder / "late.json").write_text(json.dumps(late))
    read = []
    head = paths.head
    monkeypatch.setattr(paths, "head", lambda s, p, n: read.append((p, n)) or head(s, p, n))
    scans = []
    names = files.json_names
    monkeypatch.setattr(files, "json_names", lambda s, layout: scans.append(layout.path) or names(s, layout))
    valid, _ = files.discover(spark, str(folder), COLUMNS)
    assert len(valid) == 2
    assert all(n <= files.HEADER_BYTES for _, n in read)
    # Only the file whose first objects lack a column is read for more names.
    assert [p.rsplit("/", 1)[1] for p in scans] == ["late.json"]


def test_a_staging_load_is_seen_as_a_whole(spark, tmp_path, monkeypatch):
    for job in files.INGESTS.values():
        (tmp_path / job.folder).mkdir(exist_ok=True)
    orders = tmp_path / "operations_department" / "o.csv"
    target = str(tmp_path / "staging")
    head = "order_id,user_id,estimated arrival,transaction_date\n"
    orders.write_text(head + "O1,U1,1,2021-01-02\n")
    files.load_staging(spark, str(tmp_path), target, "2024-01-01 00:00:00")
    orders.write_text(head + "O1,U2,1,2021-01-02\n")
    (tmp_path / "customer_management_department" / "u.csv").write_text(
        ",".join(files.INGESTS["stg_user_data"].required) + "\nU1,not a day,n,s,t,c,d,x,g,a,u\n"
    )
    with pytest.raises(Exception):
        files.load_staging(spark, str(tmp_path), target, "2024-01-01 00:00:00")
    assert [r.user_id for r in files.read_staging(spark, target)["stg_orders"].collect()] == ["U1"]
