"""Windows the roll-up queries are asked for; both ends count."""

# A whole quarter, a window that cuts a month, one day, one without requests.
WINDOWS = [("2024-01-01", "2024-03-31"), ("2024-01-05", "2024-01-20"), ("2024-01-09", "2024-01-09"), ("2031-01-01", "2031-12-31")]
