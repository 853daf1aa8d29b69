from tidemark.plans.job import RunParams, RunResult, build_report, run

__all__ = ["RunParams", "RunResult", "build_report", "run"]
