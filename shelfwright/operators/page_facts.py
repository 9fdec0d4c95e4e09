"""Pages to page facts: one Arrow pass, the single Python step of page extraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfwright.functions.htmlscan import PageFacts, Watch
from shelfwright.session import ship_package, use_all_cores

# Fact name -> Spark type. Only the facts asked for cross back into the JVM.
FACTS = {
    "title": "string",
    "metas": "array<struct<name:string,property:string,content:string>>",
    "heads": "array<struct<level:int,classes:array<string>,anc:array<string>,own:string,texts:array<string>>>",
    "paras": "array<struct<text:string,anc:array<string>>>",
    "links": "array<struct<pos:int,href:string,text:string,title:string,classes:array<string>,anc:array<string>>>",
    "images": "array<struct<src:string,classes:array<string>,anc:array<string>>>",
    "rows": "array<struct<pre:int,last:int,classes:array<string>,outer:struct<{marks}>,inner:struct<{marks}>,"
    "cells:array<struct<tag:string,nth:int,own:string,text:string>>>>",
    "elements": "array<struct<tag:string,pre:int,last:int,classes:array<string>,own:array<string>,"
    "outer:struct<{marks}>,inner:struct<{marks}>>>",
    "strings": "array<struct<pre:int,text:string>>",
    "kin": "array<array<struct<tag:string,pre:int,head:string,start:int,size:int,blank:boolean,text:string>>>",
    "plain": "string",
    "items": "array<struct<text:string,anc:array<string>>>",
    "marked": "map<string,struct<own:string,markup:string>>",
    "classes": "array<string>",
    "body_text": "string",
}

# Facts are handed over once this much HTML has been read, so large pages do not add up.
_FLUSH_CHARS = 32 << 20


def fact_type(fact: str, watch: Watch) -> T.DataType:
    marks = ",".join(f"{m}:int" for m in watch.marks.names)
    return T._parse_datatype_string(FACTS[fact].replace("{marks}", marks))


def page_facts(pages: DataFrame, facts, watch: Watch | None = None, keep=None) -> DataFrame:
    """Columns ``keep`` (default: all but html) plus one column per requested fact.

    No shuffle: each Arrow batch of pages is read in the task that scanned it. Filter pages
    on their URL first; a filter on facts cannot move below this step.
    """
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c != "html"] if keep is None else list(keep)
    facts, watch = list(facts), watch or Watch()
    fields = [pages.schema[c] for c in keep]
    schema = T.StructType(fields + [T.StructField(f, fact_type(f, watch)) for f in facts])
    arrow_types = [to_arrow_type(schema[f].dataType) for f in facts]

    def pack(batch, start, out):
        kept = batch.slice(start, len(out[0]))
        cols = [kept.column(c) for c in keep] + [pa.array(v, t) for v, t in zip(out, arrow_types)]
        return pa.RecordBatch.from_arrays(cols, names=keep + facts)

    def read(batches):
        for batch in batches:
            start, size, out = 0, 0, [[] for _ in facts]
            for at, html in enumerate(batch.column("html"), 1):
                text = html.as_py()
                page = PageFacts(text, watch)
                for col, name in zip(out, facts):
                    col.append(getattr(page, name)())
                size += len(text or "")
                if size > _FLUSH_CHARS:
                    yield pack(batch, start, out)
                    start, size, out = at, 0, [[] for _ in facts]
            if out[0]:
                yield pack(batch, start, out)

    return use_all_cores(pages.select(*keep, "html")).mapInArrow(read, schema)
