"""Fixed values the results depend on.

These must equal the behaviour being reproduced, so they are stated plainly
and kept together here.
"""

# --- fixed values -----------------------------------------------------------
HOME_DELIVERY = "HOME-DELIVERY"      # deliveryType that goes to the shipment output
PRIME = "PRIME"                      # customerType that earns loyalty points
LOYALTY_FACTOR = "0.02"              # earned points = totalAmount * 0.02
CGST_RATE = "0.025"                  # taxes of an assembled invoice
SGST_RATE = "0.025"
CESS_RATE = "0.00125"
WINDOW_SIZE_MINUTES = 60             # store-sales hopping window
WINDOW_ADVANCE_MINUTES = 5
WINDOW_GRACE_MINUTES = 2
COMMIT_INTERVAL_MS = 1000            # changelogs are emitted at these ticks
# Output names of the fan-out.
INPUT_TOPIC = "pos-invoice"
SHIPMENT_OUTPUT = "shipment"
LOYALTY_OUTPUT = "loyalty"
HADOOP_OUTPUT = "hadoop-sink"
STORE_SALES_OUTPUT = "store-sales"
# ---------------------------------------------------------------------------
