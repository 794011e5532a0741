"""Joins behind a size check, and intermediate results that outlive executors."""

from tallyframe.plans.durable import FOLDER_SETTING, Scratch, durable, work_folder
from tallyframe.plans.joins import join_groups

__all__ = ["FOLDER_SETTING", "Scratch", "durable", "join_groups", "work_folder"]
