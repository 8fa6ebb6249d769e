"""Column names and types of the nine input tables. Names, order and types of the files."""

from __future__ import annotations

CUSTOMERS = """
    customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string,
    customer_state string
"""
GEOLOCATION = """
    geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string,
    geolocation_state string
"""
ORDER_ITEMS = """
    order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp,
    price double, freight_value double
"""
ORDER_PAYMENTS = """
    order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double
"""
ORDER_REVIEWS = """
    review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string,
    review_creation_date timestamp, review_answer_timestamp timestamp
"""
ORDERS = """
    order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp,
    order_approved_at timestamp, order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp,
    order_estimated_delivery_date timestamp
"""
PRODUCTS = """
    product_id string, product_category_name string, product_name_lenght int, product_description_lenght int,
    product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int
"""
SELLERS = "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string"
CATEGORY_TRANSLATION = "product_category_name string, product_category_name_english string"

SCHEMAS = {
    "customers": CUSTOMERS,
    "geolocation": GEOLOCATION,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
    "orders": ORDERS,
    "products": PRODUCTS,
    "sellers": SELLERS,
    "category_translation": CATEGORY_TRANSLATION,
}

# Column that orders may be partitioned by.
YEAR_PARTITION = "order_purchase_year"
