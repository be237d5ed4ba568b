from .bands import band, band_rank
from .labels import decode_demand, demand_code, demand_label, encode_demand
from .money import format_money, mean_money, money_sums, round_money, share
from .ranking import missing_keys, ranked, with_missing_ranks
from .skills import add_skill, has_any, owned_skills, parse_skill_list

__all__ = [
    "add_skill",
    "band",
    "band_rank",
    "decode_demand",
    "demand_code",
    "demand_label",
    "encode_demand",
    "format_money",
    "has_any",
    "mean_money",
    "missing_keys",
    "money_sums",
    "owned_skills",
    "parse_skill_list",
    "ranked",
    "round_money",
    "share",
    "with_missing_ranks",
]
