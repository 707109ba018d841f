"""Rows shared by the test modules and the fixtures of conftest.py."""

# A bakery's tills: one basket of two lines, one buyer who is no member.
CREDIT_ROWS = [
    (11, "K7", "2023-12-27", "oat", "north", 6.0, 1.5, 4),
    (12, "K8", "2023-12-31", "oat", "north", 3.0, 1.5, 2),
    (13, "K7", "2024-01-01", "oat", "north", 9.0, 1.5, 6),
    (14, "K9", "2024-01-18", "oat", "south", 4.5, 1.5, 3),
    (15, "K9", "2024-01-19", "rye", "south", 8.0, 4.0, 2),
    (16, "K7", "2024-01-24", "oat", "north", 1.5, 1.5, 1),
    (16, "K7", "2024-01-24", "rye", "north", 4.0, 4.0, 1),
    (17, "K5", "2024-01-30", "oat", "north", 3.0, 1.5, 2),
]
PANEL_ROWS = [
    ("m1", "K7", "18-29", "north", "low", 1),
    ("m2", "K8", "30-49", "north", "high", 4),
    ("m3", "K9", "30-49", "south", "low", 2),
    ("m4", "K6", "50+", "south", "high", 5),
]
