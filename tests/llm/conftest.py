import duckdb
import public_tokenizers
import pytest
from pyspark import SparkContext

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"select doc_id, text, lang from '{DATA}/documents.parquet' order by doc_id").fetchall()


@pytest.fixture
def table_of(spark):
    """Rows (id, text) as a table, dealt over some partitions, with columns whose names clash with results."""
    def make(rows, schema="doc_id long, text string"):
        df = spark.createDataFrame(rows, schema)
        clash = {c: "'x'" for c in ("id", "n", "score", "kept", "part", "chunk", "n_lines", "held_out", "a", "rank")
                 if c not in df.columns}
        return df.repartition(3).selectExpr("*", *(f"{v} as {k}" for k, v in clash.items()))
    return make


@pytest.fixture
def sent(monkeypatch):
    """What a query broadcasts itself, in order."""
    out, broadcast = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: out.append(value) or broadcast(self, value))
    return out


@pytest.fixture
def sent_by_joins():
    """The types of the columns that Spark broadcasts for the joins of a frame's plan, once it has run."""
    def types(df):
        df.collect()
        nodes, out = [df._jdf.queryExecution().executedPlan().executedPlan()], set()
        while nodes:
            node = nodes.pop()
            if node.nodeName().startswith("BroadcastExchange"):
                out |= {kind for _, kind in (c.split(":", 1) for c in node.schema().simpleString()[7:-1].split(","))}
            children = node.children()
            nodes += [node.plan()] if node.nodeName().endswith("QueryStage") else [
                children.apply(i) for i in range(children.length())]
        return out

    return types
