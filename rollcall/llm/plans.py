"""The plan modules of this subpackage, in the order of their problems."""

from rollcall.llm import matching_plan, mixing_plan, names_plan, scans_plan, tokens_plan, truncation_plan, truth_plan

PLANS = [names_plan, truth_plan, scans_plan, matching_plan, tokens_plan, mixing_plan, truncation_plan]
