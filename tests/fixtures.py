"""Input rows of the reference, copied as literals (FIXTURES.md)."""

# The 18 raw orders of the medallion lab, in file order.
RAW_ORDERS = [
    ("1001", "2026-04-01 10:15:00", "laptop", "EU", "999.99", "1"),
    ("1002", "2026-04-01 11:30:00", "phone", "US", "699.50", "2"),
    ("1003", "2026-04-01 14:45:00", "tablet", "APAC", "449.00", "1"),
    ("1004", "2026-04-02 09:00:00", "laptop", "US", "1099.00", "1"),
    ("1005", "2026-04-02 13:20:00", "headphones", "EU", "199.99", "3"),
    ("1006", "2026-04-02 16:00:00", "phone", "EU", "749.99", "1"),
    ("1007", "2026-04-03 08:30:00", "tablet", "US", "529.00", "2"),
    ("1008", "2026-04-03 12:00:00", "laptop", "APAC", "1299.00", "1"),
    ("1009", "2026-04-03 15:45:00", "phone", "US", "649.00", "1"),
    ("1010", "2026-04-03 17:30:00", "headphones", "APAC", "249.99", "2"),
    ("1001", "2026-04-01 10:15:00", "laptop", "EU", "999.99", "1"),
    ("1005", "2026-04-02 13:20:01", "headphones", "EU", "199.99", "3"),
    ("1011", "2026-04-04 09:00:00", "phone", "eu", "599.00", "1"),
    ("1012", "2026-04-04 10:30:00", "tablet", "us", "479.00", "1"),
    ("1013", "2026-04-04 11:00:00", "laptop", " APAC ", "1199.00", "1"),
    ("1014", "2026-04-04 12:00:00", None, "EU", "399.00", "1"),
    ("1015", "2026-04-04 13:00:00", "phone", "US", "-50.00", "1"),
    ("1016", "2026-04-04 14:00:00", "laptop", "EU", "999.00", "0"),
]

# Rows of our own (FIXTURES §1.2 "extra rows"): each must be rejected.
EXTRA_ORDERS = [
    ("1017", "2026-04-04 15:00:00", "phone", "US", None, "1"),          # NULL amount
    ("1018", "not a time", "phone", "US", "10.00", "1"),                # bad timestamp
    ("1019", "2026-04-04 16:00:00", "phone", "US", "ten", "1"),         # bad amount
    ("1001", "2026-04-01 09:00:00", "laptop", "EU", "oops", "1"),       # earlier 1001, bad
]

# The sales table of the CRUD lab.
SALES_SCHEMA = "order_id long, region string, product string, amount double"
SALES_V0 = [(1, "EU", "laptop", 999.99), (2, "US", "phone", 699.50), (3, "EU", "tablet", 449.00),
            (4, "APAC", "laptop", 1099.00), (5, "US", "phone", 599.00), (6, "EU", "phone", 749.99)]
SALES_APPEND = [(7, "US", "laptop", 1299.00), (8, "APAC", "tablet", 399.00)]
SALES_MERGE = [(1, "EU", "laptop", 1200.00), (9, "APAC", "phone", 549.00)]

# The five word-count lines, each repeated 10,000 times.
WORD_LINES = ["spark is fast", "spark is distributed", "spark is fun",
              "docker makes spark easy", "learning spark with docker"]
