from .bagging import fit_bagged_demand, fit_bagged_salary
from .clean import clean, rejected
from .evaluate import accuracy, classification_report, regression_report
from .features import FeatureModel, category_lists, category_values, features_long, fit_features, split, with_split
from .forest import (
    Models,
    feature_importances,
    fit_demand,
    fit_salary,
    load_models,
    predict,
    salary_scorer,
    save_models,
    top_features,
)
from .medians import group_medians
from .metrics import (
    group_stats,
    industry_metrics,
    market_tally,
    overall_stats,
    results_from_tally,
    salary_by_title_exp,
    salary_distribution,
    skill_stats,
    top_skills,
    with_band,
)
from .profiles import by_profile
from .roadmap import frameworks_table, nested_roadmap, role_roadmap, skill_roadmap
from .rules import DemandRules, PayRules, pay_scorer, with_demand, with_expected_salary, with_skill_premium
from .search import search_postings
from .trees import forest_nodes, leaf_paths, predict_by_nodes, what_if_by_walk
from .what_if import predict_with_boosts, what_if

__all__ = [
    "DemandRules",
    "FeatureModel",
    "Models",
    "PayRules",
    "accuracy",
    "by_profile",
    "category_lists",
    "category_values",
    "classification_report",
    "clean",
    "feature_importances",
    "features_long",
    "fit_bagged_demand",
    "fit_bagged_salary",
    "fit_demand",
    "fit_features",
    "fit_salary",
    "forest_nodes",
    "frameworks_table",
    "group_medians",
    "group_stats",
    "industry_metrics",
    "leaf_paths",
    "load_models",
    "market_tally",
    "nested_roadmap",
    "overall_stats",
    "pay_scorer",
    "predict",
    "predict_by_nodes",
    "predict_with_boosts",
    "regression_report",
    "rejected",
    "results_from_tally",
    "role_roadmap",
    "salary_by_title_exp",
    "salary_distribution",
    "salary_scorer",
    "save_models",
    "search_postings",
    "skill_roadmap",
    "skill_stats",
    "split",
    "top_features",
    "top_skills",
    "what_if",
    "what_if_by_walk",
    "with_band",
    "with_demand",
    "with_expected_salary",
    "with_skill_premium",
    "with_split",
]
