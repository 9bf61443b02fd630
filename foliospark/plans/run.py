"""A run over a folder of books: both stages, all outputs and logs, and a state from which it goes on.

Books are taken in steps, in order of their paths. What a step writes lies in a folder of its own in every
output, and the state names the steps that are done: a step that was broken off is made again and replaces
what it had written, so no record is written twice and none is lost.

    python -m foliospark.plans.run --config config.yaml [--dry-run] [--resume] [--skip-cross-page] [--cross-page-only]
"""

from __future__ import annotations

import argparse
import math
import time
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from foliospark.operators import metrics, records
from foliospark.plans import logs
from foliospark.plans.config import Settings, load_settings
from foliospark.plans.providers import OfflineProvider, Provider
from foliospark.plans.stages import sinks, stage_one, stage_two_records
from foliospark.sources import books
from foliospark.sources.jsonl import read_json, remove, replace_jsonl, replace_text, write_json, written_or_set_aside
from foliospark.sources.tables import cut

#: Books whose pages are read, called for and written together.
BOOKS_PER_STEP = 1000


def new_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime("run_%Y%m%d_%H%M%S")


class Output:
    """A table of JSON lines, a folder ``batch=...`` for each step of each run."""

    def __init__(self, spark: SparkSession, path: str, schema: str, dead_letters: str):
        self.spark, self.path, self.schema, self.dead_letters = spark, path, schema, dead_letters

    def write(self, rows: DataFrame, run_id: str, step: str) -> bool:
        write = replace_text if self.schema == logs.EVENT else replace_jsonl
        return written_or_set_aside(rows.select(*logs.names(self.schema)), f"{self.path}/batch={run_id}-{step}", self.dead_letters, write)

    def read(self, run_id: str, steps: list[str]) -> DataFrame:
        """Rows of the steps of a run; other folders aren't read."""
        wanted = [f"{run_id}-{step}" for step in steps]
        try:
            rows = self.spark.read.schema(f"{self.schema}, batch string").json(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.schema)
        return rows.where(F.col("batch").isin(wanted)).drop("batch") if wanted else self.spark.createDataFrame([], self.schema)

    def clear(self) -> None:
        remove(self.spark, self.path)


class Run:
    """A run and its outputs. ``state`` has the run's id, its status, and the names of the steps that are done."""

    def __init__(self, spark: SparkSession, s: Settings, provider: Callable[[], Provider], run_id: str | None = None, resume: bool = False, reader: books.PageReader = books.read_pdf_pages,
                 counter: Callable[[bytes], int] = books.count_pdf_pages, books_per_step: int = BOOKS_PER_STEP):
        self.spark, self.s, self.provider, self.reader, self.counter, self.books_per_step = spark, s, provider, reader, counter, books_per_step
        r, d, c = s.runtime, s.dataset, s.cross_page
        before = read_json(spark, r.checkpoint_path) if resume and r.checkpoint_enabled else None
        self.resumed = before is not None
        self.state = before or {"run_id": run_id or new_run_id(), "status": "running", "done": []}
        self.run_id = self.state["run_id"]
        at = lambda path, schema: Output(spark, path, schema, r.failed_writes_log_path)
        self.final, self.across = at(d.output_path, logs.RECORD), at(c.output_path, logs.RECORD)
        self.artifacts, self.skipped = at(c.artifact_path, logs.ARTIFACT), at(d.skipped_pages_output_path, logs.SKIPPED)
        self.quality, self.cross_quality = at(s.quality.quality_log_path, logs.DECISION), at(c.quality_log_path, logs.CROSS_DECISION)
        self.calls, self.prompts, self.events = at(r.api_metrics_log_path, logs.CALL), at(r.prompt_log_path, logs.PROMPT), at(r.process_log_path, logs.EVENT)
        # what later steps and the report need is kept beside the state, whatever is logged
        self.candidates, self.packs, self.asked = (at(f"{r.checkpoint_path}.{name}", schema) for name, schema in (("candidates", logs.CANDIDATE), ("packs", logs.PACK), ("calls", logs.CALL)))
        self.cross_candidates = at(f"{r.checkpoint_path}.cross_candidates", logs.CANDIDATE)
        if not r.append_mode and not self.resumed:
            for out in (self.final, self.across, self.artifacts, self.skipped, self.quality, self.cross_quality, self.calls, self.prompts, self.events):
                out.clear()
            remove(spark, r.failed_writes_log_path)

    def save(self, status: str = "running") -> None:
        self.state |= {"status": status, "updated_at_epoch": int(time.time())}
        if self.s.runtime.checkpoint_enabled:
            write_json(self.spark, self.state, self.s.runtime.checkpoint_path)

    def tell(self, name: str, step: str, payload: dict) -> None:
        row = self.spark.createDataFrame([(self.run_id,)], "run_id string")
        self.events.write(logs.event(row, name, **{k: F.lit(v) for k, v in payload.items()}), self.run_id, step)

    def done(self, kind: str) -> list[str]:
        return [step for step in self.state["done"] if step.startswith(kind)]

    def plan(self, most: int) -> DataFrame:
        """``path, source_book, n_pages, target, step`` of the books; the number of pages is null for one that can't be read."""
        s = self.s.input
        found = books.list_books(self.spark, s.books_dir, s.glob)
        # one row per book, in order
        placed = found.withColumn("step", F.floor((F.row_number().over(Window.orderBy("path")) - 1) / self.books_per_step).cast("int"))
        counted = books.count_pages(self.spark, s.books_dir, self.counter, s.glob).dropDuplicates(["source_book"])
        return cut(placed.join(counted, "source_book", "left").withColumn("target", F.least("n_pages", F.lit(most))))

    def estimate(self, plan: DataFrame) -> dict:
        """Pages left, candidates and records to expect of them, at the rate of this run so far."""
        seen = self.artifacts.read(self.run_id, self.done("pages")).groupBy("source_book").agg(F.count("*").alias("seen"))
        left = plan.join(seen, "source_book", "left").agg(F.sum(F.greatest(F.col("target") - F.coalesce("seen", F.lit(0)), F.lit(0)))).first()[0] or 0
        tried = self.candidates.read(self.run_id, self.done("pages")).agg(F.count("*"), F.count_if("accepted")).first()
        per_page = self.s.dataset.qas_per_page
        return {"remaining_pages_estimate": left, "estimated_candidate_samples": left * per_page, "projected_final_samples": metrics.expected_pairs(left, per_page, tried[1], tried[0])}

    def pages(self, plan: DataFrame, number: int) -> None:
        """One step of the first stage."""
        step = f"pages-{number:05d}"
        paths = [r["path"] for r in plan.where(F.col("step") == number).select("path").collect()]  # at most books_per_step
        read = cut(books.read_pages(self.spark, paths, self.reader, dpi=self.s.runtime.dpi, most=self.s.runtime.max_pages_per_book))
        earlier = self.candidates.read(self.run_id, self.done("pages")).where("accepted").select("signature")
        finished = self.artifacts.read(self.run_id, self.done("pages")).select("source_book", "source_page")
        pages = read.where("error is null").select("path", "source_book", "source_page", "page_text", "image")
        made, decided = stage_one(pages, finished, self.provider, self.s, self.run_id, earlier, books.renderer(self.reader))
        made = cut(made)
        asked = cut(logs.page_calls(made, decided, self.s))
        before = self.candidates.read(self.run_id, self.done("pages")).agg(F.count_if("accepted"), F.count_if(~F.col("accepted") & ~F.col("duplicate"))).first()
        left = self.skipped.read(self.run_id, self.done("pages")).count()
        told = logs.page_events(made, decided, asked, (before[0], left, before[1])).unionByName(logs.event(read.where("error is not null").withColumn("run_id", F.lit(self.run_id)), "book_unreadable", book=F.col("source_book"), error=F.col("error")))
        local = records.local_records(decided.where("accepted").withColumn("artifact_id", F.lit(None)), self.s.dataset.user_profile)
        outputs = [(self.final, local), (self.artifacts, made), (self.skipped, logs.skipped(made)), (self.candidates, decided), (self.asked, asked)]
        outputs += [(self.quality, logs.decisions(decided))] if self.s.quality.enabled else []
        outputs += [(self.calls, asked)] if self.s.runtime.log_api_metrics else []
        outputs += [(self.prompts, logs.prompts(made, self.s))] if self.s.runtime.log_prompts else []
        self.finish(step, [*outputs, (self.events, told)])

    def finish(self, step: str, outputs: list[tuple[Output, DataFrame]]) -> None:
        for out, rows in outputs:
            out.write(rows, self.run_id, step)
        self.state["done"].append(step)
        self.save()

    def across_pages(self, step_of_pages: str) -> None:
        """One step of the second stage: the books of a step of the first."""
        step = step_of_pages.replace("pages", "packs")
        artifacts = self.artifacts.read(self.run_id, [step_of_pages])
        accepted = lambda out, kind: out.read(self.run_id, self.done(kind)).where("accepted").select("signature")
        earlier = accepted(self.candidates, "pages").unionByName(accepted(self.cross_candidates, "packs"))
        none = self.spark.createDataFrame([], "pack_id string")
        made, decided, packs = stage_two_records(artifacts, none, earlier, self.provider, self.s, self.run_id)
        asked = cut(logs.pack_calls(packs, decided, self.s))
        built = packs.groupBy("run_id", "source_book").agg(F.count("*").alias("n"))
        final, cross = sinks(made.limit(0), made, self.s)
        outputs = [(self.across, cross), (self.final, final), (self.cross_quality, logs.cross_decisions(decided)), (self.packs, packs), (self.cross_candidates, decided), (self.asked, asked)]
        outputs += [(self.calls, asked)] if self.s.runtime.log_api_metrics else []
        self.finish(step, [*outputs, (self.events, logs.event(built, "cross_page_packs_built", book=F.col("source_book"), pack_count=F.col("n")))])

    def report(self) -> tuple[dict, dict]:
        """The analytics report and the token statistics of all steps that are done."""
        one, two = self.done("pages"), self.done("packs")
        local = self.final.read(self.run_id, one)
        made = local.unionByName(self.across.read(self.run_id, two))
        asked = self.asked.read(self.run_id, one + two)
        row = metrics.report(self.artifacts.read(self.run_id, one), self.candidates.read(self.run_id, one), made, self.packs.read(self.run_id, two), self.cross_candidates.read(self.run_id, two), asked).first().asDict()
        counted = metrics.token_stats(asked.withColumn("metric_id", F.monotonically_increasing_id())).collect()  # a row per kind of call
        groups = {r["call_group"]: {k: r[k] for k in ("input_tokens", "output_tokens", "calls")} for r in counted}
        zero = {"input_tokens": 0, "output_tokens": 0, "calls": 0}
        return metrics.rounded({"run_id": self.run_id, **row}), {"run_id": self.run_id, **{g: groups.get(g, zero) for g in ("totals", "generation", "critique")}}


def run(spark: SparkSession, s: Settings, provider: Callable[[], Provider], run_id: str | None = None, resume: bool = False, dry_run: bool = False, skip_cross_page: bool = False, cross_page_only: bool = False,
        reader: books.PageReader = books.read_pdf_pages, counter: Callable[[bytes], int] = books.count_pdf_pages, books_per_step: int = BOOKS_PER_STEP) -> dict:
    """Runs both stages (or one) over the books of the settings and returns the report.

    A dry run takes one page per book. With ``resume`` a run goes on from its state, if there is one; without, it is a new one, so
    that ``cross_page_only`` finds no pages unless it resumes. With append_mode off a new run clears the outputs first.
    """
    if dry_run:
        s = replace(s, runtime=replace(s.runtime, max_pages_per_book=1))
    this = Run(spark, s, provider, run_id, resume, reader, counter, books_per_step)
    if not cross_page_only:
        plan = this.plan(s.runtime.max_pages_per_book)
        n = plan.agg(F.count("*")).first()[0]
        this.tell("run_started", "start", {"books": n, "resume": resume, **this.estimate(plan)})
        for number in range(math.ceil(n / books_per_step)):
            if f"pages-{number:05d}" not in this.state["done"]:
                this.pages(plan, number)
    if s.cross_page.enabled and not skip_cross_page:
        for step in this.done("pages"):
            if step.replace("pages", "packs") not in this.state["done"]:
                this.across_pages(step)
    report, tokens = this.report()
    write_json(spark, report, s.analytics.report_path)
    write_json(spark, tokens, s.analytics.token_stats_path)
    this.save("completed")
    kept = ("total_candidate_qas", "quality_rejected", "duplicates_filtered", "skipped_pages", "estimated_total_cost_usd")
    this.tell("run_completed", "end", {"total_records": report["local_accepted"], **{k: report[k] for k in kept}, "average_api_latency_ms": report["api_average_latency_ms"]})
    return report


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Books to chat records, page by page and across pages.")
    parser.add_argument("--config", default="config.yaml")
    for flag, text in (("--dry-run", "one page per book"), ("--resume", "go on from the state of the last run"), ("--skip-cross-page", "first stage only"), ("--cross-page-only", "second stage only")):
        parser.add_argument(flag, action="store_true", help=text)
    parser.add_argument("--text", action="store_true", help="books are plain text with form feeds between pages")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    kinds = {"reader": books.read_text_pages, "counter": books.count_text_pages} if a.text else {}
    report = run(spark, load_settings(a.config), OfflineProvider, resume=a.resume, dry_run=a.dry_run, skip_cross_page=a.skip_cross_page, cross_page_only=a.cross_page_only, **kinds)
    print(f"{report['run_id']}: {report['total_records']} records, {report['skipped_pages']} pages skipped, {report['estimated_total_cost_usd']} USD")


if __name__ == "__main__":
    main()
