"""A small hand-made set of raw CSV files covering the awkward cases."""

from __future__ import annotations

from pathlib import Path

FILES = {
    "customers.csv": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,1037, São Paulo ,SP\n"
        "c2,u1,1037,sao paulo,SP\n"
        "c3,u1,200,Niterói,RJ\n"
        "c4,u2,1037,São Paulo,SP\n"
        "c5,u2,00200,Niterói,RJ\n"
        "c6,u3,99999,\"Rio, Centro\",RJ\n"
    ),
    "geolocation.csv": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "1037,-23.5,-46.6,São Paulo,sp\n"
        "1037,-23.7,-46.4,sao paulo,SP\n"
        "01037,-23.6,-46.5,osasco,SP\n"
        "99,10,-46,x,XX\n"
        "200,-34,-32,b,XX\n"
        "200,6,-74,a,XX\n"
    ),
    "orders.csv": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 11:00:00,junk,2018-01-09 23:00:00,2018-01-10 00:00:00\n"
        "o2,c2,delivered,2018-01-02 10:00:00,2018-01-02 10:10:00,2018-01-03 00:00:00,2018-01-11 12:00:00,2018-01-10 23:00:00\n"
        "o3,c5,shipped,2018-02-01 10:00:00,2018-02-01 10:00:01,2018-13-01 00:00:00,,2018-02-20 00:00:00\n"
        "o4,c6,delivered,2018-02-03 10:00:00,2018-02-03 10:00:00,2018-02-04 00:00:00,2018-02-21 00:00:00,2018-02-20 00:00:00\n"
    ),
    "order_items.csv": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-05 00:00:00,10.50,1.25\n"
        "o1,2,p2,s1,2018-01-05 00:00:00,20,0\n"
        "o2,1,p3,s2,not a date,30.25,2\n"
        "o4,1,p9,s1,2018-02-05 00:00:00,5,1\n"
    ),
    "order_payments.csv": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1, Credit_Card,2,10.0\n"
        "o1,2,voucher,1,5.5\n"
        "o2,1,boleto,1,32.25\n"
    ),
    "order_reviews.csv": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        "r1,o1,4,NA,\"two\nlines, \"\"quoted\"\"\",2018-01-12 00:00:00,2018-01-13 10:00:00\n"
        "r2,o1,5,,null,2018-01-12 00:00:00,\n"
        "r3,o1,5,ok,\"\",2018-01-12 00:00:00,2018-01-14 00:00:00\n"
        "r1,o2,1,bad,late,2018-01-20 00:00:00,2018-01-21 00:00:00\n"
    ),
    "products.csv": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
        "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,perfumaria,40,287,1,225,16,10,14\n"
        "p2,pc_gamer,44,276,1,1000,30,18,20\n"
        "p3,,,,,154,18,9,15\n"
    ),
    "sellers.csv": (
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,01037,SÃO JOÃO D'OESTE,sc\n"
        "s2,123456,osasco, sp\n"
    ),
    "category_translation.csv": (
        "product_category_name,product_category_name_english\n"
        "perfumaria,perfumery\n"
    ),
}


def write(folder: Path, **changes: str | None) -> str:
    """Write the files; ``changes`` replaces or (None) leaves out single entities."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in FILES.items():
        entity = name.removesuffix(".csv")
        text = changes.get(entity, text)
        if text is not None:
            (folder / name).write_text(text, encoding="utf-8")
    return str(folder)
