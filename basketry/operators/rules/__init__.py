"""Candidate rules. Each is a small frozen object with one method, ``retrieve()``."""

from .base import FilterRule, GlobalRule, ItemGroupRule, PersonalRule, UserGroupRule
from .factor import ALS, BPR, UserGroupALS, UserGroupBPR
from .groups import UserGroupSaleTrend, UserGroupTimeHistory
from .history import OrderHistory, OrderHistoryDecay
from .itemcf import ItemCF, UserGroupItemCF
from .pairs import ItemPair
from .popular import SaleTrend, TimeHistory, TimeHistoryDecay
from .stock import OutOfStock

__all__ = [
    "ALS", "BPR", "FilterRule", "GlobalRule", "ItemCF", "ItemGroupRule", "ItemPair",
    "OrderHistory", "OrderHistoryDecay", "OutOfStock", "PersonalRule", "SaleTrend",
    "TimeHistory", "TimeHistoryDecay", "UserGroupALS", "UserGroupBPR", "UserGroupItemCF",
    "UserGroupRule", "UserGroupSaleTrend", "UserGroupTimeHistory",
]
