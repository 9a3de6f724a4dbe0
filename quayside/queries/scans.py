"""Scans. The given tables are parquet, so they are first written in the format to be scanned."""

from __future__ import annotations

import io
import zipfile
from datetime import date
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import functions as F

from quayside.queries.register import as_text, money, query, table
from quayside.session import scratch_path
from quayside.sources import delimited, documents, pipelines, tables, workbook


@query(
    "scan_delimited",
    "select o_orderkey::varchar o_orderkey, o_orderstatus, o_totalprice, 'São ' || o_orderpriority as city from orders",
)
def scan_delimited(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    comma = F.replace(money("o_totalprice"), F.lit("."), F.lit(","))
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        comma.alias("o_totalprice"),
        F.concat(F.lit("São "), "o_orderpriority").alias("city"),
        F.lit("unused").alias("unused"),
    )
    rows.write.options(sep=";", encoding="ISO-8859-1", header=True).csv(path)
    return delimited.scan_delimited(
        spark, path, sep=";", encoding="latin1", decimal=",", decimal_columns=["o_totalprice"], usecols="A:D"
    )


@query(
    "scan_gz_pipe",
    """select o_orderkey::varchar o_orderkey, o_custkey::varchar o_custkey, '"' || o_orderpriority o_orderpriority,
              case when o_orderstatus <> 'P' then o_orderstatus end o_orderstatus from orders""",
)
def scan_gz_pipe(spark, sf_dir):
    path = scratch_path(spark, "gz-pipe")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.concat(F.lit('"'), "o_orderpriority").alias("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    rows.write.options(sep="|", quote="", escape="", header=True, compression="gzip").csv(path)
    return delimited.scan_gz_pipe(spark, path)


@query("scan_json_lines", "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders")
def scan_json_lines(spark, sf_dir):
    path = scratch_path(spark, "json-lines")
    table(spark, sf_dir, "orders").drop("o_orderdate", "o_orderstatus").write.json(path)
    return documents.scan_json_lines(
        spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    )


@query(
    "scan_mixed_folder",
    """select o_orderkey::varchar o_orderkey, case when o_orderkey % 3 <> 1 then o_orderpriority end o_orderpriority,
              case when o_orderkey % 3 <> 0 then o_orderstatus end o_orderstatus from orders""",
)
def scan_mixed_folder(spark, sf_dir):
    path = scratch_path(spark, "mixed")
    orders = table(spark, sf_dir, "orders")
    third = F.col("o_orderkey") % 3
    orders.filter(third == 0).select("o_orderkey", "o_orderpriority").write.json(path)
    csv = {"header": True, "mode": "append"}
    orders.filter(third == 1).select("o_orderkey", "o_orderstatus").write.csv(path, **csv)
    orders.filter(third == 2).select("o_orderstatus", "o_orderkey", "o_orderpriority").write.csv(path, **csv)
    return documents.scan_mixed_folder(spark, path).drop("source_file")


@query("scan_parquet", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def scan_parquet(spark, sf_dir):
    return tables.scan_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


def _sheet_xml(rows) -> str:
    out = []
    for r, cells in enumerate(rows, 1):
        line = []
        for i, cell in enumerate(cells):
            ref = f"{chr(65 + i)}{r}"
            if isinstance(cell, (int, float)):
                line.append(f'<c r="{ref}"><v>{cell!r}</v></c>')
            elif cell is not None:
                line.append(f'<c r="{ref}" t="inlineStr"><is><t>{escape(cell)}</t></is></c>')
        out.append(f'<row r="{r}">{"".join(line)}</row>')
    return "".join(out)


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A small workbook with the given sheets of rows."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    listed = "".join(
        f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>' for i, name in enumerate(sheets, 1)
    )
    rels = "".join(
        f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>'
        for i in range(1, len(sheets) + 1)
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>',
        )
        for i, rows in enumerate(sheets.values(), 1):
            used = f"A1:{chr(64 + max(map(len, rows)))}{len(rows)}"
            data = f'<worksheet xmlns="{main}"><dimension ref="{used}"/><sheetData>{_sheet_xml(rows)}</sheetData></worksheet>'
            book.writestr(f"xl/worksheets/sheet{i}.xml", data)
    return out.getvalue()


def _customer_workbooks(spark, sf_dir):
    """One workbook per Arrow batch of customers, with their names on one sheet and balances on another."""

    def books(batches):
        for batch in batches:
            rows = batch.to_pylist()
            sheets = {
                "Clientes": [["Código", "Nome"], *[[r["c_custkey"], r["c_name"]] for r in rows]],
                "Saldos": [["Código", "Saldo"], *[[r["c_custkey"], r["c_acctbal"]] for r in rows]],
            }
            name = f"clientes-{rows[0]['c_custkey']}.xlsx"
            yield pa.RecordBatch.from_pydict({"path": [name], "content": [workbook_bytes(sheets)]})

    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "workbooks")
    customers.mapInArrow(books, "path string, content binary").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "scan_workbooks",
    """select 'Clientes' sheet, 0 sheet_index, c_custkey::varchar a, c_name b from customer
       union all select 'Saldos', 1, c_custkey::varchar, cast(cast(c_acctbal as decimal(18,2)) as varchar) from customer""",
)
def scan_workbooks(spark, sf_dir):
    rows = workbook.scan_workbooks(_customer_workbooks(spark, sf_dir)).filter("row > 0")
    second = F.col("cells")[1]
    amount = second.try_cast("decimal(18,2)").cast("string")
    return rows.select(
        "sheet",
        "sheet_index",
        F.col("cells")[0].alias("a"),
        F.when(F.col("sheet") == "Saldos", amount).otherwise(second).alias("b"),
    )


@query(
    "workbook_fanout",
    """select 'nomes' output, c_custkey::varchar codigo, c_name nome, null::varchar saldo from customer
       union all select 'saldos', c_custkey::varchar, null, cast(cast(c_acctbal as decimal(18,2)) as varchar) from customer""",
)
def workbook_fanout(spark, sf_dir):
    files = _customer_workbooks(spark, sf_dir)
    outputs = workbook.workbook_fanout(files, {"nomes": "Clientes", "saldos": "1"})
    names = outputs["nomes"].select(
        F.lit("nomes").alias("output"),
        F.col("Código").alias("codigo"),
        F.col("Nome").alias("nome"),
        F.lit(None).cast("string").alias("saldo"),
    )
    balances = outputs["saldos"].select(
        F.lit("saldos").alias("output"),
        F.col("Código").alias("codigo"),
        F.lit(None).cast("string").alias("nome"),
        F.col("Saldo").cast("decimal(18,2)").cast("string").alias("saldo"),
    )
    return names.unionByName(balances)


def _envelopes(spark, sf_dir):
    """One API document per order, with none to three records; every tenth has a null payload."""
    n = (F.col("o_orderkey") % 4).cast("int")
    record = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.col("o_orderkey").alias("order"), i.alias("id"), money("o_totalprice").alias("price")),
    )
    payload = F.when(F.col("o_orderkey") % 10 != 9, F.to_json(record)).otherwise("null")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit('{"status": 200, "payload": '), payload, F.lit("}")).alias("body")
    )


@query(
    "scan_envelope",
    """select o_orderkey as "order", i::int id, cast(o_totalprice as decimal(18,2))::varchar price
       from (select o_orderkey, o_totalprice, unnest(generate_series(1, o_orderkey % 4)) i
             from orders where o_orderkey % 10 <> 9)""",
)
def scan_envelope(spark, sf_dir):
    elements = documents.scan_envelope(_envelopes(spark, sf_dir))
    record = F.from_json("element", "order bigint, id int, price string")
    return elements.select(record.alias("r")).select("r.*")


def _pages(spark, sf_dir):
    """One page of three items per order; the pages of every 97th order were lost."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).scalar()
    items = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct(
            (F.col("o_orderkey") * 3 + i).alias("sku"), F.concat("o_orderpriority", F.lit("é")).alias("reference_code")
        ),
    )
    body = F.struct(
        F.struct(((last + 1) * 3 - 1).alias("total"), F.lit(3).alias("limit"), items.alias("scan")).alias("data")
    )
    return orders.select((F.col("o_orderkey") + 1).alias("page"), F.to_json(body).alias("body")).filter(
        (F.col("page") == 1) | (F.col("page") % 97 != 6)
    )


@query(
    "scan_pages",
    """select o_orderkey + 1 as page, o_orderkey * 3 + i sku, o_orderpriority || 'é' reference_code
       from orders, generate_series(0, 2) g(i) where o_orderkey = 0 or (o_orderkey + 1) % 97 <> 6""",
)
def scan_pages(spark, sf_dir):
    return documents.page_items(_pages(spark, sf_dir), "sku: bigint, reference_code: string", keep=["page"])


@query("page_gaps", "select o_orderkey + 1 as page from orders where (o_orderkey + 1) % 97 = 6 and o_orderkey > 0")
def page_gaps(spark, sf_dir):
    return documents.page_gaps(_pages(spark, sf_dir))


def events_with_deleted(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("deleted", F.col("event_type") == "error")


@query(
    "scan_collection",
    """select event_id, user_id, value, props from events
       where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' and event_type <> 'error'""",
)
def scan_collection(spark, sf_dir):
    return tables.scan_collection(
        events_with_deleted(spark, sf_dir),
        "ts",
        "2024-01-05",
        "2024-01-20",
        projection=["user_id", "value", "props"],
        key="event_id",
    )


FREE_QUERY = """
    select user_id, event_type, count(*) as n, max(value) as top_value, min(ts) as first_ts
    from {events} where event_type <> 'error' group by user_id, event_type
"""


@query(
    "scan_free_query",
    """select user_id, event_type, count(*) as n, max(value) as top_value, min(ts)::varchar as first_ts
       from events where event_type <> 'error' group by user_id, event_type""",
)
def scan_free_query(spark, sf_dir):
    return tables.scan_free_query(spark, FREE_QUERY, events=table(spark, sf_dir, "events"))


#: A pipeline as a configuration holds it: the filter reaches the scan, the lookup that is unwound is a plain join.
FREE_PIPELINE = """[
  {"$match": {"o_orderdate": {"$gte": {"$date": "1994-01-01T00:00:00Z"}, "$lt": {"$date": "1998-01-01T00:00:00Z"}},
              "o_orderstatus": {"$in": ["F", "O"]},
              "lines": {"$elemMatch": {"quantity": {"$gte": 30}, "flag": {"$ne": "A"}}}}},
  {"$addFields": {"year": {"$year": "$o_orderdate"},
                  "heavy": {"$size": {"$filter": {"input": "$lines", "as": "l", "cond": {"$gte": ["$$l.quantity", 30]}}}}}},
  {"$lookup": {"from": "customer", "localField": "o_custkey", "foreignField": "c_custkey", "as": "customer"}},
  {"$unwind": "$customer"},
  {"$unwind": {"path": "$lines", "includeArrayIndex": "place"}},
  {"$match": {"$expr": {"$lt": ["$place", 3]}, "customer.c_acctbal": {"$not": {"$lt": 0}}}},
  {"$group": {"_id": {"segment": "$customer.c_mktsegment", "year": "$year"}, "n": {"$sum": 1}, "quantity": {"$sum": "$lines.quantity"},
              "parts": {"$addToSet": "$lines.part"}, "heavy": {"$max": "$heavy"}, "least": {"$min": "$lines.quantity"}}},
  {"$project": {"_id": 0, "n": 1, "quantity": 1, "heavy": 1, "n_parts": {"$size": "$parts"}, "year": "$_id.year",
                "label": {"$concat": [{"$toLower": "$_id.segment"}, "-", {"$toString": "$_id.year"}]},
                "kind": {"$switch": {"branches": [{"case": {"$gt": ["$least", 1]}, "then": "no singles"}], "default": "singles"}}}},
  {"$sort": {"label": 1}}
]"""


def nested_orders(spark, sf_dir):
    """Orders with their lines inside, in the order of their numbers, as a stored collection."""
    line = F.struct(
        F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag")
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    path = scratch_path(spark, "orders")
    table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey").write.parquet(path)
    return spark.read.parquet(path)


@query(
    "scan_free_pipeline",
    """with numbered as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_returnflag) as place from lineitem),
       chosen as (
         select o.*, (select count(*) from lineitem where l_orderkey = o_orderkey and l_quantity >= 30) as heavy from orders o
         where o_orderdate >= timestamp '1994-01-01' and o_orderdate < timestamp '1998-01-01' and o_orderstatus in ('F', 'O')
           and exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity >= 30 and l_returnflag <> 'A'))
       select count(*) as n, sum(l_quantity) as quantity, max(heavy)::int as heavy, count(distinct l_partkey)::int as n_parts, year(o_orderdate)::int as "year",
              lower(c_mktsegment) || '-' || year(o_orderdate) as label, case when min(l_quantity) > 1 then 'no singles' else 'singles' end as kind
       from chosen join customer on o_custkey = c_custkey join numbered on l_orderkey = o_orderkey
       where place <= 3 and not c_acctbal < 0 group by c_mktsegment, year(o_orderdate)""",
)
def scan_free_pipeline(spark, sf_dir):
    return pipelines.aggregate(nested_orders(spark, sf_dir), FREE_PIPELINE, {"customer": table(spark, sf_dir, "customer")})


#: Arrays made and looked into: the last order of each customer, and what was ordered, with the customers that ordered nothing.
LOOKUP_PIPELINE = """[
  {"$match": {"c_mktsegment": {"$nin": ["MACHINERY"]}}},
  {"$lookup": {"from": "orders", "let": {"key": "$c_custkey"}, "as": "orders", "pipeline": [
      {"$match": {"$expr": {"$and": [{"$eq": ["$o_custkey", "$$key"]}, {"$gt": ["$o_totalprice", 1000]}]}}},
      {"$project": {"_id": 0, "o_orderkey": 1, "o_totalprice": 1}}]}},
  {"$project": {"_id": 0, "c_custkey": 1, "n": {"$size": "$orders"}, "top": {"$max": "$orders.o_totalprice"},
                "dear": {"$size": {"$filter": {"input": "$orders", "cond": {"$gte": ["$$this.o_totalprice", 50000]}}}},
                "some": {"$cond": [{"$gt": [{"$size": "$orders"}, 0]}, "yes", "no"]}}},
  {"$unionWith": {"coll": "orders", "pipeline": [
      {"$sort": {"o_custkey": 1, "o_orderdate": -1, "o_orderkey": 1}},
      {"$group": {"_id": "$o_custkey", "last": {"$first": "$o_orderkey"}, "days": {"$push": {"$dateToString": {"date": "$o_orderdate", "format": "%Y-%m-%d"}}}}},
      {"$project": {"_id": 0, "c_custkey": "$_id", "last": 1, "newest": {"$arrayElemAt": ["$days", 0]}, "oldest": {"$arrayElemAt": ["$days", -1]}}}]}}
]"""


@query(
    "scan_free_lookup",
    """select c_custkey, count(o_orderkey)::int as n, max(o_totalprice) as top, count(*) filter (o_totalprice >= 50000)::int as dear,
              case when count(o_orderkey) > 0 then 'yes' else 'no' end as some, null::bigint as last, null::varchar as newest, null::varchar as oldest
       from customer left join orders on o_custkey = c_custkey and o_totalprice > 1000 where c_mktsegment <> 'MACHINERY' group by c_custkey
       union all
       select o_custkey, null, null, null, null, first(o_orderkey order by o_orderdate desc, o_orderkey), max(o_orderdate)::date::varchar, min(o_orderdate)::date::varchar
       from orders group by o_custkey""",
)
def scan_free_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return pipelines.aggregate(table(spark, sf_dir, "customer"), LOOKUP_PIPELINE, {"orders": orders})


def day_of(name: str):
    return F.col(name).cast("date")


def _dated_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("dt", day_of("o_orderdate"))


@query(
    "external_table",
    """select o_orderkey, 'line 1, "' || o_orderpriority || '"' || chr(10) || 'line 2' as note, o_totalprice,
              o_orderdate::date::varchar as dt from orders""",
)
def external_table(spark, sf_dir):
    path = scratch_path(spark, "external")
    note = F.concat(F.lit('line 1, "'), "o_orderpriority", F.lit('"\nline 2'))
    rows = _dated_orders(spark, sf_dir).select("o_orderkey", note.alias("note"), "o_totalprice", "dt")
    rows.hint("rebalance", F.col("dt")).write.options(header=True, escape='"').partitionBy("dt").csv(path)
    schema = "o_orderkey bigint, note string, o_totalprice double, dt date"
    return tables.external_table(spark, path, "csv", schema, multi_line=True)


@query(
    "run_folder",
    "select o_orderkey, o_custkey, '1997-03-04' as dt from orders where o_orderdate::date = date '1997-03-04'",
)
def run_folder(spark, sf_dir):
    path = scratch_path(spark, "runs")
    rows = _dated_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "dt")
    rows.hint("rebalance", F.col("dt")).write.partitionBy("dt").parquet(path)
    return tables.run_folder(tables.external_table(spark, path), date(1997, 3, 4))


def landed_text(spark, sf_dir, name: str):
    return as_text(table(spark, sf_dir, name))
