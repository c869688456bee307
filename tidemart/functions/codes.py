"""Codes of the shop's dictionary (fixed values) with our own names."""

from __future__ import annotations

PAID = "1602"
FINISHED = "1004"

ORDER_STATUS = "10"
PAYMENT_TYPE = "11"
ACTIVITY_TYPE = "31"
COUPON_TYPE = "32"
COUPON_RANGE = "33"

DICTIONARY_COLUMNS = "dic_code string, dic_name string, parent_code string"
DICTIONARY = [
    ("1001", "unpaid", "10"), ("1002", "paid", "10"), ("1003", "cancelled", "10"),
    ("1004", "finished", "10"), ("1005", "refund requested", "10"), ("1006", "refunded", "10"),
    ("1101", "alipay", "11"), ("1102", "wechat", "11"), ("1103", "unionpay", "11"),
    ("1601", "payment open", "16"), ("1602", "payment done", "16"), ("1603", "payment closed", "16"),
    ("3101", "money off", "31"), ("3102", "pieces off", "31"), ("3103", "discount", "31"),
    ("3201", "money off coupon", "32"), ("3202", "pieces off coupon", "32"),
    ("3203", "cash coupon", "32"),
    ("3301", "category", "33"), ("3302", "brand", "33"), ("3303", "single product", "33"),
]
