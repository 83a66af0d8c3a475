"""The feature contract of graph snapshots: node and edge types, their columns, normalisers and fill policies."""

from __future__ import annotations

from dataclasses import dataclass

SCHEMA_VERSION = "1.0.0"


@dataclass(frozen=True)
class Feature:
    name: str
    normaliser: str
    fill: str = "zero"  # zero, mean or drop_node


#: Features by node type, in the order of their columns.
NODES: dict[str, tuple[Feature, ...]] = {
    "player": (
        Feature("acs", "minmax"),
        Feature("kast", "minmax"),
        Feature("adr", "minmax"),
        Feature("hs_pct", "minmax"),
        Feature("rating", "minmax"),
        Feature("fb_rate", "minmax"),
        Feature("fd_rate", "minmax"),
        Feature("clutch_rate", "minmax"),
        Feature("multikill_rate", "minmax"),
        Feature("latent_skill", "zscore"),
        Feature("role_fit", "minmax"),
        Feature("synergy_mag", "minmax"),
        Feature("age_days", "log1p_minmax"),
        Feature("region_americas", "passthrough"),
        Feature("region_emea", "passthrough"),
        Feature("region_pacific", "passthrough"),
        Feature("region_china", "passthrough"),
        Feature("tier_rank", "minmax"),
    ),
    "team": (
        Feature("avg_acs", "minmax"),
        Feature("avg_kast", "minmax"),
        Feature("win_rate", "minmax"),
        Feature("map_win_rate", "minmax"),
        Feature("attack_rwr", "minmax"),
        Feature("defense_rwr", "minmax"),
        Feature("eco_efficiency", "minmax"),
        Feature("comeback_rate", "minmax"),
        Feature("strength_rating", "zscore"),
        Feature("style_aggression", "minmax"),
        Feature("style_utility", "minmax"),
        Feature("region_americas", "passthrough"),
        Feature("region_emea", "passthrough"),
        Feature("region_pacific", "passthrough"),
        Feature("region_china", "passthrough"),
        Feature("tier_rank", "minmax"),
        Feature("roster_age_days", "log1p_minmax"),
    ),
    "patch": (
        Feature("agg_match_acs", "minmax"),
        Feature("agg_match_kast", "minmax"),
        Feature("duration_days", "log1p_minmax"),
        Feature("matches_played", "log1p_minmax"),
        Feature("agents_added", "minmax"),
        Feature("maps_added", "minmax"),
        Feature("meta_magnitude", "passthrough"),
        Feature("is_major_shift", "passthrough"),
        Feature("era_ordinal", "minmax"),
        Feature("season_year_2024", "passthrough"),
        Feature("season_year_2025", "passthrough"),
        Feature("season_year_2026", "passthrough"),
    ),
    "agent": (
        Feature("avg_acs_when_picked", "minmax"),
        Feature("avg_rating_when_picked", "minmax"),
        Feature("pick_rate", "minmax"),
        Feature("win_rate_when_picked", "minmax"),
        Feature("ban_rate", "minmax"),
        Feature("strength_score", "minmax"),
        Feature("synergy_index", "minmax"),
        Feature("role_duelist", "passthrough"),
        Feature("role_controller", "passthrough"),
        Feature("role_initiator", "passthrough"),
        Feature("role_sentinel", "passthrough"),
        Feature("age_days", "log1p_minmax"),
    ),
}
#: Attributes by (source type, relation, target type).
EDGES: dict[tuple[str, str, str], tuple[Feature, ...]] = {
    ("player", "plays_for", "team"): (Feature("tenure_days", "log1p_minmax"), Feature("role_slot", "minmax")),
    ("team", "relates_to", "team"): (Feature("rivalry_strength", "minmax"), Feature("head_to_head_count", "log1p_minmax")),
    ("team", "sponsored_by", "team"): (Feature("annual_value_usd", "log1p_minmax"), Feature("tenure_days", "log1p_minmax")),
    ("patch", "affects", "agent"): (Feature("change_magnitude", "minmax"), Feature("buff_direction", "passthrough")),
}
