from wardlens.plans.batch import run_batch

__all__ = ["run_batch"]
