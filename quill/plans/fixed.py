"""Rates and thresholds that must equal the reference's for the
reports to compute the same thing, kept together as plain text in the order
the reports use them. Values chosen for the test tables (income ranges,
segment names, band edges, dates) are report parameters instead."""

# Fixed values.
TICKET_BONUS_HIGH = (100_000, "0.07")   # ticket amount above 100,000 → 7%
TICKET_BONUS_MID = (50_000, "0.05")     # above 50,000 (up to 100,000) → 5%; else 0
SALES_MIN_TOTAL = 50_000                # cashiers kept above this total sold
HEALTH_BONUS_RATE = "0.01"              # bonus for the named public health system
TENURE_BONUS_RATES = ("0.10", "0.15")   # up to the tenure cut / above it
SALARY_RAISE_RATES = ("1.10", "1.15")   # month's fees below the threshold / otherwise
FINE_RATE_PER_DAY = "0.03"              # of the book price, per day late
FINE_REBATE_PCT = 20                    # for the listed careers
VAT_TEXT = "19%"
VAT_RATE = "0.19"
VAT_REFUND_RATE = "0.05"                # of the declared amount, after the refund years
MAJOR_CLIENT_MIN = 3                    # advisories for a major client; 1-2 frequent; 0 new
CREDIT_RATIO_CRITICAL = "0.8"           # balance / credit above → critical
CREDIT_RATIO_REGULAR = "0.5"            # above → regular; otherwise good
OFFER_FACTOR = "0.9"                    # offer price: 90% of the unit price
PERCENT = "0.01"
SUPPLIER_MIN_BALANCE = 3000             # a served nation has a supplier above it
