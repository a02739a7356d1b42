"""Batch jobs of hosted models: build, submit, poll, consume.

Network calls are driver-side actions through a client object and never part of a plan; jobs are a
small table written as TSV.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparquill.operators.tasks import Task, joined, responses
from sparquill.sources.jsonl import read_job_map, read_lines, require_nonempty, write_document, write_requests

WINDOW = "24h"


class Client(Protocol):
    """What a hosted batch service must offer."""

    def submit(self, path: str, window: str) -> dict: ...
    def status(self, batch_id: str) -> dict: ...


@dataclass
class LocalClient:
    """Stand-in: every submitted folder is a completed batch whose results lie where ``results`` says."""

    results: dict[str, str] = field(default_factory=dict)
    n: int = 0

    def submit(self, path: str, window: str) -> dict:
        self.n += 1
        batch = f"batch_{self.n:04d}"
        self.results.setdefault(batch, path + "_out")
        return {"batch_id": batch, "status": "validating", "input_file_id": f"file_{self.n:04d}"}

    def status(self, batch_id: str) -> dict:
        return {"batch_id": batch_id, "status": "completed", "output": self.results.get(batch_id)}


@dataclass
class Job:
    jsonl: str
    meta: str
    batch_id: str
    status: str
    input_file_id: str


def submit(spark: SparkSession, client: Client, path: str, window: str = WINDOW) -> Job:
    if window != WINDOW:
        raise ValueError(f"the service knows only the {WINDOW} window")
    require_nonempty(spark, path, "request file")
    got = client.submit(path, window)
    job = Job(path, path.rstrip("/") + ".meta", got["batch_id"], got["status"], got["input_file_id"])
    write_document(spark.createDataFrame([{k: str(v) for k, v in {"jsonl": path, "completion_window": window, **got}.items()}]), job.meta)
    return job


def run_split(spark: SparkSession, client: Client, requests: DataFrame, path: str, chunk: int) -> list[Job]:
    """Write requests in chunks and submit exactly the chunks written now, in order."""
    names = sorted(r["name"] for r in write_requests(requests, path, chunk).collect())  # one name per chunk
    return [submit(spark, client, f"{path}/name={n}") for n in names]


def job_table(spark: SparkSession, jobs: list[Job]) -> DataFrame:
    return spark.createDataFrame([asdict(j) for j in jobs], "jsonl string, meta string, batch_id string, status string, input_file_id string")


def write_job_map(jobs: DataFrame, path: str) -> None:
    jobs.select(F.concat_ws("\t", *(F.coalesce(c, F.lit("")) for c in ("jsonl", "meta", "batch_id", "status", "input_file_id"))).alias("value")).write.mode("overwrite").text(path)


def read_jobs(spark: SparkSession, path: str) -> list[Job]:
    """The jobs of a written map, one per submitted file."""
    return [Job(r["jsonl"], r["meta"], r["batch_id"], r["status"] or "", r["input_file_id"] or "") for r in read_job_map(spark, path).orderBy("jsonl").collect()]


def refreshed(jobs: list[Job], client: Client) -> list[Job]:
    return [Job(j.jsonl, j.meta, j.batch_id, client.status(j.batch_id)["status"], j.input_file_id) for j in jobs]


def consume(spark: SparkSession, client: Client, jobs: list[Job], source: DataFrame, task: Task) -> tuple[DataFrame, DataFrame]:
    """(usable responses joined to their rows, failed ones) of all completed jobs that have an output."""
    states = [client.status(j.batch_id) for j in jobs]
    paths = [s["output"] for s in states if s["status"] == "completed" and s.get("output")]
    if not paths:
        raise RuntimeError("no completed job with an output")
    return joined(responses(read_lines(spark, paths), task), source)
