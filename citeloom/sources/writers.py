"""Writers: logs, tables, graph files, pages, batches, checksums and idempotent inserts.

Graph files, tables, pages and batches are written by the tasks that hold their rows, through the data source of `textfiles`.
Only `append_lines` and `write_lines`, which keep one log file of a warehouse on this machine, take rows through the driver.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
from collections.abc import Callable
from pathlib import Path
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text
from citeloom.operators.graph import cut_lineage
from citeloom.operators.labels import numbered as in_order

from .textfiles import fixed_text, json_text, rendered, section, write_files, write_sections


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def _plain(value):
    return {k: _plain(v) for k, v in value.items() if v is not None} if isinstance(value, dict) else value


def append_lines(df: DataFrame, path: str) -> int:
    """Appends rows to one log file of a warehouse on this machine, one after the other. Returns the rows written."""
    n = 0
    with Path(path).open("a", encoding="utf-8") as out:
        for n, r in enumerate(df.toLocalIterator(), 1):
            out.write(json.dumps(_plain(r.asDict(True)), ensure_ascii=False) + "\n")
    return n


def write_lines(df: DataFrame, path: str, *order: str) -> int:
    """The same into a new file that takes the old one's place when it is whole."""
    fresh = Path(path + ".new")
    fresh.unlink(missing_ok=True)
    n = append_lines(df.orderBy(*order) if order else df, str(fresh))
    fresh.replace(path)
    return n


def write_json(path: str, value) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str) + "\n", encoding="utf-8")


def known_keys(spark: SparkSession, path: str, key: str = "key") -> DataFrame:
    """(key) of a table of worked keys; a table that isn't there yet has none."""
    from citeloom.sources.records import path_exists

    schema = f"{key} string"
    return spark.read.schema(schema).parquet(path).distinct() if path_exists(spark, path) else spark.createDataFrame([], schema)


def mark_keys(keys: DataFrame, path: str, key: str = "key") -> None:
    """Adds keys to the table that known_keys() reads, those that it hasn't got."""
    fresh = keys.select(F.col(key).cast("string").alias(key)).distinct().join(known_keys(keys.sparkSession, path, key), key, "left_anti")
    fresh.write.mode("append").parquet(path)


def replace_line(path: str, record: dict, key: str = "paper_id") -> None:
    """Puts a record into a log in place of those with its key in any case."""
    where = Path(path)
    lines = where.read_text(encoding="utf-8").splitlines() if where.exists() else []
    kept = [x for x in lines if x.strip() and str(json.loads(x).get(key, "")).lower() != str(record[key]).lower()]
    where.parent.mkdir(parents=True, exist_ok=True)
    where.write_text("\n".join([*kept, json.dumps(record, ensure_ascii=False)]) + "\n", encoding="utf-8")


def overwrite_log(df: DataFrame, path: str, *order: str) -> None:
    (df.orderBy(*order) if order else df).write.mode("overwrite").json(path)


def insert_new(df: DataFrame, existing: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """Rows of df whose key isn't there yet, the first of each key: what an insert-or-ignore would add."""
    # a key that is there often goes once: tables of them are larger than what is added
    fresh = df.join(existing.select(*keys).distinct(), keys, "left_anti")
    if order is None:
        return fresh.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    return fresh.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*").select(*df.columns)


def replaced(df: DataFrame, record: DataFrame, key: str = "paper_id") -> DataFrame:
    """df without the record's key in any case, and the record."""
    gone = record.select(F.lower(key).alias("__key"))
    return df.join(gone, F.lower(df[key]) == F.col("__key"), "left_anti").unionByName(record)


def write_csv(df: DataFrame, path: str) -> None:
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def labelled_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.col("paper_id").alias("Id"), text.short_label(F.col("title")).alias("Label"), *[c for c in nodes.columns if c not in ("paper_id", "title")])


_XML = {"string": "string", "int": "int", "bigint": "long", "double": "double", "boolean": "boolean"}


def _split(path: str) -> tuple[str, str]:
    folder, _, name = path.rpartition("/")
    return folder or ".", name


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str, key: str = "paper_id") -> int:
    """GraphML with every other column of nodes as an attribute; missing ones are left out. Returns the edges written."""
    fields = [(c, _XML.get(k, "string")) for c, k in nodes.dtypes if c != key]
    keys = "".join(f'  <key id="{c}" for="node" attr.name="{c}" attr.type="{kind}"/>\n' for c, kind in fields)
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n' + keys
    head += '  <key id="relation" for="edge" attr.name="relation" attr.type="string"/>\n  <graph edgedefault="directed">\n'

    def node(r: dict) -> str:
        data = "".join(f'<data key="{c}">{escape(str(r[c]))}</data>' for c, _ in fields if r[c] not in (None, ""))
        return f"    <node id={quoteattr(str(r[key]))}>{data}</node>\n"

    def edge(r: dict) -> str:
        return f'    <edge id="e{r["place"]}" source={quoteattr(str(r["src"]))} target={quoteattr(str(r["dst"]))}><data key="relation">cites</data></edge>\n'

    spark, (folder, name) = nodes.sparkSession, _split(path)
    ends = cut_lineage(edges.select("src", "dst"))
    parts = [fixed_text(spark, head, 0, name), section(nodes, [F.col(key)], node, 1, name), section(ends, [F.col("src"), F.col("dst")], edge, 2, name), fixed_text(spark, "  </graph>\n</graphml>\n", 3, name)]
    write_sections(parts, folder)
    return ends.count()


def write_gexf(nodes: DataFrame, edges: DataFrame, path: str, colors: dict[str, tuple[int, int, int]]) -> None:
    """GEXF 1.2 of nodes (paper_id, title, category, x, y, size) with positions, sizes and colours."""
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<gexf xmlns="http://www.gexf.net/1.2draft" xmlns:viz="http://www.gexf.net/1.2draft/viz" version="1.2">\n<graph defaultedgetype="directed">\n<nodes>\n'

    def node(r: dict) -> str:
        red, green, blue = colors.get(r["category"], (120, 130, 128))
        return (
            f"<node id={quoteattr(str(r['paper_id']))} label={quoteattr(str(r['title'] or r['paper_id']))}>"
            f'<viz:position x="{r["x"]}" y="{r["y"]}" z="0.0"/><viz:size value="{r["size"]}"/><viz:color r="{red}" g="{green}" b="{blue}"/></node>\n'
        )

    def edge(r: dict) -> str:
        return f'<edge id="{r["place"]}" source={quoteattr(str(r["src"]))} target={quoteattr(str(r["dst"]))} label="cites"/>\n'

    spark, (folder, name) = nodes.sparkSession, _split(path)
    between, tail = fixed_text(spark, "</nodes>\n<edges>\n", 2, name), fixed_text(spark, "</edges>\n</graph>\n</gexf>\n", 4, name)
    parts = [fixed_text(spark, head, 0, name), section(nodes, [F.col("paper_id")], node, 1, name), between, section(edges.select("src", "dst"), [F.col("src"), F.col("dst")], edge, 3, name), tail]
    write_sections(parts, folder)


def _numbered_graph(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with `__n`, their numbers in the order of ids, and edges with those of their ends, `__s` and `__t`, by joins."""
    named = cut_lineage(in_order(nodes, [F.col("paper_id")]).withColumnRenamed("place", "__n"))
    ids = named.select("paper_id", "__n")
    pairs = edges.join(ids.toDF("src", "__s"), "src").join(ids.toDF("dst", "__t"), "dst")
    return named, pairs.select("src", "dst", "__s", "__t")


def _listed(r: dict, text: str) -> str:
    """An item of a JSON list: commas stand before all but the first."""
    return (",\n" if r["place"] else "\n") + text


def write_cx(nodes: DataFrame, edges: DataFrame, path: str, name: str) -> None:
    """CX JSON; nodes are numbered in order of their id and named by their title."""
    named, pairs = _numbered_graph(nodes, edges)
    extra = [c for c in nodes.columns if c not in ("paper_id", "title")]
    kinds = dict(nodes.dtypes)
    values = F.array(*[F.struct(F.lit(c).alias("c"), (F.initcap(F.col(c).cast("string")) if kinds[c] == "boolean" else F.col(c).cast("string")).alias("v"), F.lit(k).alias("k")) for k, c in enumerate(extra)]) if extra else F.array().cast("array<struct<c:string,v:string,k:int>>")
    attributes = named.select("__n", F.explode(values).alias("e")).select("__n", "e.*").where("v is not null and v <> ''")
    spark, (folder, file) = nodes.sparkSession, _split(path)
    head = json.dumps([{"networkAttributes": [{"n": "name", "v": name}]}], ensure_ascii=False)[:-1]
    parts = [
        fixed_text(spark, head + ',\n{"nodes": [', 0, file),
        section(named, [F.col("__n")], lambda r: _listed(r, json_text({"@id": r["__n"], "n": r["title"] or str(r["paper_id"]), "r": str(r["paper_id"])})), 1, file),
        fixed_text(spark, '\n]},\n{"edges": [', 2, file),
        section(pairs, [F.col("src"), F.col("dst")], lambda r: _listed(r, json_text({"@id": r["place"], "s": r["__s"], "t": r["__t"], "i": "cites"})), 3, file),
        fixed_text(spark, '\n]},\n{"nodeAttributes": [', 4, file),
        section(attributes, [F.col("__n"), F.col("k")], lambda r: _listed(r, json_text({"po": r["__n"], "n": r["c"], "v": r["v"]})), 5, file),
        fixed_text(spark, "\n]}]", 6, file),
    ]
    write_sections(parts, folder)


def write_web_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """The JSON of a web viewer: nodes (paper_id, title, year, venue, category, x, y, size, degree) and pairs of their numbers."""
    named, pairs = _numbered_graph(nodes, edges)
    names, (folder, file), spark = nodes.columns, _split(path), nodes.sparkSession
    parts = [
        fixed_text(spark, '{"nodes": [', 0, file),
        section(named, [F.col("__n")], lambda r: _listed(r, json_text({c: r[c] for c in names})), 1, file),
        fixed_text(spark, '\n], "edges": [', 2, file),
        section(pairs, [F.col("__s"), F.col("__t")], lambda r: ("," if r["place"] else "") + f"[{r['__s']},{r['__t']}]", 3, file),
        fixed_text(spark, "]}\n", 4, file),
    ]
    write_sections(parts, folder)


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, sha256) of files."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))


def write_checksums(folder: str, names: list[str]) -> None:
    """SHA256SUMS of files of a folder, in the order of their names given; a file is read a piece at a time."""
    lines = []
    for n in names:
        with (Path(folder) / n).open("rb") as file:
            lines.append(f"{hashlib.file_digest(file, 'sha256').hexdigest()}  {n}")
    (Path(folder) / "SHA256SUMS").write_text("\n".join(lines) + "\n", encoding="utf-8")


def _csv_line(values: list) -> str:
    out = io.StringIO(newline="")
    csv.writer(out).writerow(["" if x is None else x for x in values])
    return out.getvalue()


def write_table(rows: DataFrame, path: str, *order: str) -> int:
    """One CSV file with a header and empty cells for nulls. Returns the rows written."""
    names, (folder, file) = rows.columns, _split(path)
    kept = cut_lineage(rows)
    body = section(kept, [F.col(c) for c in order], lambda r: _csv_line([r[c] for c in names]), 1, file)
    write_sections([fixed_text(rows.sparkSession, _csv_line(names), 0, file), body], folder)
    return kept.count()


def write_release(nodes: DataFrame, edges: DataFrame, stats: DataFrame, folder: str, version: str = "v1") -> dict:
    """The files of a released graph: tables, GraphML, statistics, a page about them, and checksums. Returns the statistics."""
    where = Path(folder)
    found = {"version": version, **stats.first().asDict()}
    sizes = {"nodes": found["nodes"], "edges": found["edges"], "isolated nodes": found["isolated_nodes"], "nodes of the largest component": found["largest"], "self-loops removed": found["self_loops_removed"]}
    where.mkdir(parents=True, exist_ok=True)
    write_page(f"{folder}/README.md", "\n".join([f"# Citation graph {version}", "", *(f"- {n:,} {name}" for name, n in sizes.items()), ""]))
    write_table(nodes, f"{folder}/nodes.csv", "paper_id")
    write_table(edges.select(F.col("src").alias("source"), F.col("dst").alias("target"), F.lit("cites").alias("relation")), f"{folder}/edges.csv", "source", "target")
    write_graphml(nodes, edges, f"{folder}/network.graphml")
    (where / "stats.json").write_text(json.dumps(found, indent=2) + "\n", encoding="utf-8")
    write_checksums(folder, ["nodes.csv", "edges.csv", "network.graphml", "stats.json", "README.md"])
    return found


def write_pages(lines: DataFrame, folder: str) -> int:
    """Pages of (page, place, line) rows. Returns the pages written.

    All pages are looked at first, so one edited by hand stops the run before anything changes; generated pages of the
    folders written to that are no more go.
    """
    names = [r["page"] for r in lines.select("page").distinct().toLocalIterator()]
    folders = {(Path(folder) / n).parent for n in names}
    old = [p for f in folders if f.exists() for p in f.glob("*.md")]
    for p in old:
        if not _generated(p):
            raise FileExistsError(f"{p} was edited by hand")

    def line(r: dict) -> str:
        if r["line"] is None:
            return MARKER + "\n"
        return ("\n" if r["line"].startswith("#") else "") + r["line"] + "\n" + ("" if r["line"].startswith(("- ", "|")) else "\n")

    kind = dict(lines.dtypes)["place"]
    heads = lines.select("page").distinct().select("page", F.lit(0).alias("body"), F.lit(None).cast(kind).alias("place"), F.lit(None).cast("string").alias("line"))
    rows = lines.select("page", F.lit(1).alias("body"), "place", "line").unionByName(heads)
    write_files(rendered(rows, line, "page", "body", "place").withColumnRenamed("page", "file"), folder, "body", "place")
    kept = {Path(folder) / n for n in names}
    for p in old:
        if p not in kept:
            p.unlink()
    return len(names)


def write_neighbourhood(nodes: DataFrame, edges: DataFrame, page: str, folder: str, name: str) -> dict:
    """A neighbourhood's nodes and edges as JSON lines and its summary page. Returns the counts."""
    where = Path(folder)
    where.mkdir(parents=True, exist_ok=True)
    counts = {}
    for kind, df, order in (("nodes", nodes, ("paper_id",)), ("edges", edges, ("source", "target", "relation"))):
        names, kept = df.columns, cut_lineage(df)
        # values as JSON take any type of column; null fields stay
        text_of = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("__row")
        placed = section(kept.select(*order, text_of), [F.col(c) for c in order], lambda r: json.dumps(json.loads(r["__row"]), ensure_ascii=False, sort_keys=True) + "\n", 0, f"{name}.{kind}.jsonl")
        write_sections([placed, fixed_text(df.sparkSession, "", 1, f"{name}.{kind}.jsonl")], folder)
        counts[kind] = kept.count()
    (where / f"{name}.md").write_text(page, encoding="utf-8")
    return counts


def write_batches(numbered: DataFrame, folder: str, prefix: str = "batch", start: int | None = None) -> int:
    """Numbered batches as JSON arrays, a file each. Without `start` older files go; else they stay.

    numbered has `batch` and what a file shall hold. Returns the files written.
    """
    where = Path(folder)
    where.mkdir(parents=True, exist_ok=True)
    if start is None:
        for old in where.glob(f"{prefix}_*.json"):
            old.unlink()
    columns = [c for c in numbered.columns if c not in ("batch", "place")]
    file = F.concat(F.lit(f"{prefix}_"), F.lpad((F.col("batch") + (start or 0)).cast("string"), 4, "0"), F.lit(".json"))
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row")
    if "place" in numbered.columns:
        kept = cut_lineage(numbered.select(file.alias("file"), F.col("place").cast("long").alias("place"), row))
    else:
        kept = in_order(numbered.select(file.alias("file"), row), [F.col("file"), F.col("row")])
    # a comma stands before every row but a file's first
    rows = kept.join(kept.groupBy("file").agg(F.min("place").alias("__first")), "file")
    body = rendered(rows.select("file", "place", "row", "__first"), lambda r: ("[\n" if r["place"] == r["__first"] else ",\n") + json_text(json.loads(r["row"])), "file", "place")
    tail = kept.select("file").distinct().select("file", F.lit((1 << 63) - 1).alias("place"), F.lit("\n]\n").alias("text"))
    write_files(body.unionByName(tail), folder, "place")
    return kept.select("file").distinct().count()


def upserted(rows: DataFrame, client: Callable[[], Callable[[str, list[dict]], None]], statement: str, size: int = 500) -> None:
    """Sends rows to a graph database in batches, from the tasks that hold them. The statement has to be idempotent (a merge),
    as a lost task is run again; client() makes a connection in the task, which takes a statement and rows."""

    def send(part) -> None:
        run, batch = client(), []
        for r in part:
            batch.append(r.asDict(True))
            if len(batch) >= size:
                run(statement, batch)
                batch = []
        if batch:
            run(statement, batch)

    rows.foreachPartition(send)


MARKER = "<!-- generated page; do not edit -->"


def _generated(path: Path) -> bool:
    return path.read_text(encoding="utf-8").startswith(MARKER)


def write_page(path: str, body: str) -> None:
    """Writes a page, unless a file without the marker, so one edited by hand, is there."""
    where = Path(path)
    if where.exists() and not _generated(where):
        raise FileExistsError(f"{path} was edited by hand")
    where.parent.mkdir(parents=True, exist_ok=True)
    where.write_text(f"{MARKER}\n{body}", encoding="utf-8")


def sync_pages(folder: str, pages: dict[str, str]) -> None:
    """Writes all pages of a folder and removes generated ones that are no more."""
    for name, body in pages.items():
        write_page(f"{folder}/{name}", body)
    for old in Path(folder).glob("*.md"):
        if old.name not in pages and _generated(old):
            old.unlink()
