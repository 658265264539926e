"""Fixed seed values: a small OLTP data set with edge cases (failed then
retried payment, dispute, split payment, inactive customer without
orders, recent status changes). Times are days before a fixed clock.
Only the columns the checks use are kept."""

# Fixed values.
# customers: email, full_name, segment, country_code, is_active, created_days, updated_days
CUSTOMERS = [
    ("alice.johnson@acmecorp.com", "Alice Johnson", "enterprise", "US", True, 88, 2),
    ("bob.smith@techwave.io", "Bob Smith", "smb", "US", True, 75, 5),
    ("carol.white@sunrise.de", "Carol White", "enterprise", "DE", True, 60, 1),
    ("david.lee@fastmail.jp", "David Lee", "consumer", "JP", True, 55, 10),
    ("emma.brown@globalink.co.uk", "Emma Brown", "smb", "GB", True, 48, 3),
    ("frank.garcia@cloudbase.es", "Frank Garcia", "consumer", "ES", True, 40, 7),
    ("grace.kim@nexustech.kr", "Grace Kim", "enterprise", "KR", True, 33, 1),
    ("henry.zhang@datasync.cn", "Henry Zhang", "smb", "CN", True, 25, 4),
    ("isabella.rossi@primotech.it", "Isabella Rossi", "consumer", "IT", True, 15, 2),
    ("james.wilson@inactiveuser.ca", "James Wilson", "smb", "CA", False, 90, 60),
]

# products: sku, name, category, unit_price
PRODUCTS = [
    ("SOFT-ANLYT-001", "Analytics Pro", "Software", "1200.00"),
    ("SOFT-ANLYT-002", "Analytics Starter", "Software", "149.00"),
    ("SOFT-ETL-001", "DataBridge ETL", "Software", "2400.00"),
    ("SOFT-ML-001", "ML Studio", "Software", "3600.00"),
    ("HW-LAPTOP-001", "ProBook 15", "Hardware", "1899.99"),
    ("HW-LAPTOP-002", "UltraSlim 13", "Hardware", "1199.99"),
    ("HW-MON-001", "4K Monitor 27\"", "Hardware", "699.99"),
    ("HW-DOCK-001", "USB-C Docking Station", "Hardware", "199.99"),
    ("SVC-ONBOARD-001", "Onboarding Package", "Services", "999.00"),
    ("SVC-SUPPORT-001", "Support Gold", "Services", "1800.00"),
    ("SVC-TRAIN-001", "Training Bootcamp", "Services", "2500.00"),
    ("HW-LAPTOP-003", "DevStation Pro", "Hardware", "3499.99"),
    ("SOFT-SEC-001", "SecureVault", "Software", "899.00"),
    ("HW-HEADSET-001", "NoiseCancel Pro", "Hardware", "349.99"),
    ("SOFT-COLLAB-001", "TeamFlow", "Software", "599.00"),
]

# orders: order_ref, email, status, order_total, tax_amount, created_days, updated_days
# (0.25 days = 6 hours)
ORDERS = [
    ("ORD-000001", "alice.johnson@acmecorp.com", "delivered", "2399.99", "192.00", 85, 80),
    ("ORD-000002", "bob.smith@techwave.io", "delivered", "1349.99", "108.00", 72, 67),
    ("ORD-000003", "carol.white@sunrise.de", "delivered", "3600.00", "684.00", 58, 53),
    ("ORD-000004", "david.lee@fastmail.jp", "delivered", "699.99", "63.00", 52, 47),
    ("ORD-000005", "emma.brown@globalink.co.uk", "delivered", "4299.99", "344.00", 45, 40),
    ("ORD-000006", "frank.garcia@cloudbase.es", "cancelled", "349.99", "31.50", 42, 41),
    ("ORD-000007", "grace.kim@nexustech.kr", "delivered", "2200.00", "198.00", 30, 25),
    ("ORD-000008", "henry.zhang@datasync.cn", "shipped", "1899.99", "152.00", 20, 18),
    ("ORD-000009", "isabella.rossi@primotech.it", "processing", "999.00", "89.91", 12, 12),
    ("ORD-000010", "alice.johnson@acmecorp.com", "delivered", "5499.99", "440.00", 40, 35),
    ("ORD-000011", "bob.smith@techwave.io", "confirmed", "1200.00", "108.00", 8, 8),
    ("ORD-000012", "carol.white@sunrise.de", "delivered", "2899.99", "551.00", 35, 30),
    ("ORD-000013", "grace.kim@nexustech.kr", "delivered", "4799.99", "432.00", 28, 23),
    ("ORD-000014", "emma.brown@globalink.co.uk", "refunded", "699.99", "56.00", 50, 22),
    ("ORD-000015", "david.lee@fastmail.jp", "pending", "199.99", "18.00", 1, 1),
    ("ORD-000016", "henry.zhang@datasync.cn", "delivered", "3499.99", "280.00", 22, 17),
    ("ORD-000017", "isabella.rossi@primotech.it", "confirmed", "349.99", "31.50", 3, 3),
    ("ORD-000018", "alice.johnson@acmecorp.com", "processing", "2400.00", "192.00", 5, 5),
    ("ORD-000019", "frank.garcia@cloudbase.es", "shipped", "899.00", "80.91", 10, 8),
    ("ORD-000020", "bob.smith@techwave.io", "delivered", "1800.00", "162.00", 18, 13),
    ("ORD-000021", "grace.kim@nexustech.kr", "confirmed", "3600.00", "324.00", 2, 2),
    ("ORD-000022", "carol.white@sunrise.de", "pending", "1199.99", "96.00", 0.25, 0.25),
    ("ORD-000023", "henry.zhang@datasync.cn", "delivered", "599.00", "47.92", 14, 9),
    ("ORD-000024", "emma.brown@globalink.co.uk", "cancelled", "2500.00", "200.00", 6, 5),
    ("ORD-000025", "david.lee@fastmail.jp", "shipped", "549.98", "49.50", 4, 2),
]

# order items: order_ref, sku, quantity, discount_pct
ORDER_ITEMS = [
    ("ORD-000001", "SOFT-ANLYT-001", 1, 0), ("ORD-000001", "HW-DOCK-001", 1, 0),
    ("ORD-000002", "HW-LAPTOP-002", 1, 0), ("ORD-000003", "SOFT-ML-001", 1, 0),
    ("ORD-000004", "HW-MON-001", 1, 0), ("ORD-000005", "HW-LAPTOP-001", 2, 5),
    ("ORD-000005", "HW-DOCK-001", 2, 0), ("ORD-000006", "HW-HEADSET-001", 1, 0),
    ("ORD-000007", "SOFT-ETL-001", 1, 0), ("ORD-000007", "SVC-ONBOARD-001", 1, 0),
    ("ORD-000008", "HW-LAPTOP-001", 1, 0), ("ORD-000009", "SVC-ONBOARD-001", 1, 0),
    ("ORD-000010", "HW-LAPTOP-003", 1, 10), ("ORD-000010", "HW-MON-001", 1, 5),
    ("ORD-000010", "HW-HEADSET-001", 1, 5), ("ORD-000011", "SOFT-ANLYT-001", 1, 0),
    ("ORD-000012", "HW-LAPTOP-002", 1, 0), ("ORD-000012", "SVC-SUPPORT-001", 1, 0),
    ("ORD-000013", "SOFT-ML-001", 1, 0), ("ORD-000013", "SVC-TRAIN-001", 1, 0),
    ("ORD-000013", "HW-DOCK-001", 2, 0), ("ORD-000014", "HW-MON-001", 1, 0),
    ("ORD-000015", "HW-DOCK-001", 1, 0), ("ORD-000016", "HW-LAPTOP-003", 1, 0),
    ("ORD-000017", "HW-HEADSET-001", 1, 0), ("ORD-000018", "SOFT-ETL-001", 1, 0),
    ("ORD-000019", "SOFT-SEC-001", 1, 0), ("ORD-000020", "SVC-SUPPORT-001", 1, 0),
    ("ORD-000021", "SOFT-ML-001", 1, 0), ("ORD-000022", "HW-LAPTOP-002", 1, 0),
    ("ORD-000023", "SOFT-COLLAB-001", 1, 10), ("ORD-000024", "SVC-TRAIN-001", 1, 0),
    ("ORD-000025", "SOFT-ANLYT-002", 2, 0), ("ORD-000025", "HW-HEADSET-001", 1, 0),
]

# payments: order_ref, payment_method, status (amount = the order's total)
PAYMENTS = [
    ("ORD-000001", "card", "captured"), ("ORD-000002", "card", "captured"),
    ("ORD-000003", "bank_transfer", "captured"), ("ORD-000004", "wallet", "captured"),
    ("ORD-000005", "card", "captured"), ("ORD-000006", "card", "refunded"),
    ("ORD-000007", "bank_transfer", "captured"), ("ORD-000008", "card", "captured"),
    ("ORD-000009", "card", "authorised"), ("ORD-000010", "card", "captured"),
    ("ORD-000011", "bank_transfer", "authorised"), ("ORD-000012", "card", "captured"),
    ("ORD-000013", "wallet", "captured"), ("ORD-000014", "card", "refunded"),
    ("ORD-000015", "card", "pending"), ("ORD-000016", "bank_transfer", "captured"),
    ("ORD-000017", "card", "authorised"), ("ORD-000018", "card", "authorised"),
    ("ORD-000019", "wallet", "captured"), ("ORD-000020", "card", "captured"),
    ("ORD-000021", "bank_transfer", "authorised"), ("ORD-000022", "card", "pending"),
    ("ORD-000023", "card", "captured"), ("ORD-000024", "card", "refunded"),
    ("ORD-000025", "wallet", "captured"), ("ORD-000009", "card", "failed"),
    ("ORD-000005", "card", "disputed"), ("ORD-000010", "wallet", "captured"),
]

# updates applied after the inserts
ORDER_STATUS_UPDATES = [("ORD-000022", "confirmed"), ("ORD-000017", "processing"), ("ORD-000021", "shipped")]
CUSTOMER_SEGMENT_UPDATES = [("bob.smith@techwave.io", "enterprise")]
PRODUCT_PRICE_UPDATES = [("SOFT-ANLYT-001", "1099.99")]
