"""Controlled vocabularies, patterns and id ranges of the retail entities."""

AS_OF = "2026-08-01"

EMAIL = r"\A[^@\s]+@[^@\s]+\.[^@\s]+\z"
MOBILE = r"\A[6-9][0-9]{9}\z"
POSTAL_CODE = r"\A[0-9]{6}\z"
TRANSACTION = r"\ATXN[0-9]+\z"

COUNTRY = "India"
GENDERS = ("Male", "Female", "Other")
LOYALTY_TIERS = ("Bronze", "Silver", "Gold")
PARTY_STATUSES = ("Active", "Inactive")

PRODUCT_STATUSES = ("Active", "Inactive", "Discontinued")
TAXONOMY = {
    "Electronics": ("Mobiles", "Laptops", "Headphones", "Cameras", "Smart Watches", "Accessories"),
    "Fashion": ("Men's Clothing", "Women's Clothing", "Footwear", "Watches", "Accessories"),
    "Home & Kitchen": ("Cookware", "Furniture", "Home Decor", "Storage", "Kitchen Appliances"),
    "Beauty & Personal Care": ("Skincare", "Haircare", "Makeup", "Fragrances", "Personal Hygiene"),
    "Grocery": ("Staples", "Snacks", "Beverages", "Dairy", "Personal Care"),
    "Sports & Fitness": ("Fitness Equipment", "Sportswear", "Outdoor Gear", "Yoga"),
    "Books": ("Fiction", "Non-Fiction", "Academic", "Children's Books", "Comics"),
    "Toys": ("Action Figures", "Educational Toys", "Board Games", "Outdoor Toys", "Puzzles"),
    "Automotive": ("Car Accessories", "Bike Accessories", "Car Care", "Tools"),
    "Health & Wellness": ("Supplements", "Medical Devices", "Ayurveda", "Personal Health"),
}

ORDER_STATUSES = ("Pending", "Confirmed", "Shipped", "Delivered", "Cancelled", "Returned")
COMPLETED_STATUSES = ("Confirmed", "Shipped", "Delivered")
PAYMENT_METHODS = ("UPI", "Credit Card", "Debit Card", "Net Banking", "Cash on Delivery", "Wallet")

PAYMENT_STATUSES = ("Pending", "Success", "Failed", "Refunded", "Cancelled")
SETTLED_STATUSES = ("Success", "Refunded")
CURRENCIES = ("INR",)
GATEWAYS = ("Razorpay", "PayU", "Cashfree", "Stripe")

WAREHOUSES = ("W001", "W002", "W003", "W004", "W005", "W006", "W007", "W008", "W009", "W010")
STOCK_STATUSES = ("In Stock", "Low Stock", "Out of Stock", "Overstocked")

# Largest id number of each kind.
MAX_CUSTOMER = 50_000
MAX_ORDER = 50_000
MAX_PRODUCT = 10_000
MAX_SELLER = 1_000
