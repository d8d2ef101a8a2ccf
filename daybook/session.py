"""Session set-up, the shared scratch folder, steps that run at the same time, and shuffle files that go early."""

import functools
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def get_session(app_name: str = "daybook", **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared folder named by `spark.checkpoint.dir`.

    Without that setting a folder of this machine will do only where the whole
    of Spark runs on this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/daybook/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"daybook-{purpose}-")


def frees_shuffles(job: Callable) -> Callable:
    """A job whose first argument is the session, with the shuffle files of each query gone when the query ends.

    Else they stay until the driver collects its garbage, so a job of many
    writes holds the files of all of them. A stage that is needed again is
    computed again.
    """
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        before = spark.conf.get(cleanup, None)
        spark.conf.set(cleanup, "true")
        try:
            return job(spark, *args, **kwargs)
        finally:
            if before is None:
                spark.conf.unset(cleanup)
            else:
                spark.conf.set(cleanup, before)

    return run


def at_once(*steps: Callable) -> list:
    """The results of steps that do not need each other, whose jobs share the cluster.

    While the last tasks of one step run, tasks of another take the free cores.
    All steps have ended when this returns or raises the first error among them.
    """
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(step)) for step in steps]
        wait(running)
    return [step.result() for step in running]
