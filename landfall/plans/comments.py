"""What each column of the three detail contracts means, as the catalog shows it."""

from __future__ import annotations

SHIPMENT = {
    "id": "technical key: the item's id, or the negated shipment id where a shipment has no item",
    "relate_id": "id of the shipment in the source system",
    "create_time": "time at which the batch was synchronised",
    "shipment_id": "shipment number given by the marketplace",
    "sid": "shop id",
    "seller": "shop name as the source writes it",
    "country": "marketplace of the newest listing of shop and SKUs",
    "shipment_name": "name of the shipment",
    "shipping_mode": "mode of transport, known codes as labels",
    "alpha_name": "carrier name",
    "shipment_status": "state of the shipment",
    "working_time": "when work on the shipment began",
    "shipped_time": "when it was shipped",
    "receiving_time": "when receiving began",
    "closed_time": "when it was closed",
    "is_closed": "whether it is closed, known codes as labels",
    "reference_id": "reference number of the marketplace",
    "username": "user who made the shipment",
    "gmt_create": "creation time in the source",
    "gmt_modified": "time of the last change in the source",
    "msku": "seller SKU of the item",
    "fnsku": "fulfilment SKU of the item",
    "asin": "product number of the listing, else the item's own",
    "parent_asin": "product number of the listing's parent",
    "local_name": "product name of the listing",
    "sku": "local SKU of the item",
    "quantity_shipped": "units declared as shipped",
    "quantity_shipped_local": "units shipped by the local warehouse",
    "quantity_received": "units received",
    "prep_labelowner": "who labels the units",
    "aad_diff": "units declared minus units shipped locally",
    "rad_diff": "units received minus units shipped locally",
    "aar_diff": "units declared minus units received",
    "ship_from_name": "sender: name",
    "ship_from_phone": "sender: telephone",
    "ship_from_postal_code": "sender: postal code",
    "ship_from_country_code": "sender: country code",
    "ship_from_state_or_province_code": "sender: state or province",
    "ship_from_city": "sender: city",
    "ship_from_address_line1": "sender: address",
    "ship_to_name": "recipient: name",
    "ship_to_postal_code": "recipient: postal code",
    "ship_to_country_code": "recipient: country code",
    "ship_to_state_or_province_code": "recipient: state or province",
    "ship_to_city": "recipient: city",
    "ship_to_address_line1": "recipient: address",
    "ship_to_doorplate": "recipient: house number",
}

PRICE_CHANGE = {
    "id": "technical key: the change's business id as a number",
    "relate_id": "business id as a number, for joins",
    "delete_flag": "0, rows are never marked as deleted",
    "msku": "seller SKU",
    "local_sku": "local SKU",
    "fnsku": "fulfilment SKU",
    "asin": "product number",
    "local_name": "product name",
    "store_name": "shop name",
    "marketplace": "marketplace of the shop",
    "processing_status_text": "state of the change as text",
    "adjust_type": "kind of the change",
    "queue_create_time": "when the change was queued",
    "finish_time": "when it was done",
    "sid": "shop id",
    "processing_status": "state of the change as a code",
    "create_user": "user who queued it",
    "asin_url": "address of the product page",
    "business_id": "business id as the source writes it",
    "can_audit": "whether it can be approved",
    "small_image_url": "address of a small picture",
    "failure_reason": "why it failed",
    "currency_icon": "currency sign of the profit estimate",
    "profit_estimate_standard_price_profit": "expected profit at the standard price",
    "profit_estimate_standard_price_profit_rate": "expected profit rate at the standard price",
    "profit_estimate_sale_price_profit": "expected profit at the sale price",
    "profit_estimate_sale_price_profit_rate": "expected profit rate at the sale price",
    "adjust_before_obj_standard_price": "before the change: standard price",
    "adjust_before_obj_sale_price": "before the change: sale price",
    "adjust_before_obj_sale_time_range": "before the change: period of the sale price",
    "adjust_before_obj_icon": "before the change: currency sign",
    "adjust_after_obj_standard_price": "after the change: standard price",
    "adjust_after_obj_sale_price": "after the change: sale price",
    "adjust_after_obj_sale_time_range": "after the change: period of the sale price",
    "adjust_after_obj_icon": "after the change: currency sign",
    "adjust_range_standard_price": "change of the standard price",
    "adjust_range_sale_price": "change of the sale price",
    "adjust_before": "values before the change, a JSON list",
    "adjust_after": "values after the change, a JSON list",
    "audit_info": "approvals, a JSON list",
    "backup_time": "time at which the batch was synchronised",
    "ods_update_time": "time at which the batch was synchronised",
    "create_time": "time at which the batch was synchronised",
    "update_time": "time at which the batch was synchronised",
}

RESTOCKING = {
    "parent_id": "0 for a parent; for a child the batch date and its parent's position in the batch",
    "create_time": "time at which the batch was synchronised",
    "node_type": "kind of the node",
    "data_type": "kind of its data",
    "asin": "product number",
    "sync_time": "time of the node's own data",
    "hash_id": "id of the node",
    "sid": "shop id",
    "listing_create_time": "when the listing of this SKU pair was opened",
    "msku": "seller SKU",
    "fnsku": "fulfilment SKU",
    "afn_fulfillable_quantity": "marketplace stock: ready for sale",
    "afn_reserved_quantity": "marketplace stock: reserved",
    "amazon_quantity_shipping": "marketplace stock: on the way",
    "reserved_fc_transfers": "marketplace stock: moving between centres",
    "amazon_quantity_valid": "marketplace stock: usable in all",
    "afn_inbound_receiving_quantity": "marketplace stock: being received",
    "reserved_fc_processing": "marketplace stock: being processed",
    "amazon_quantity_shipping_plan": "marketplace stock: planned shipments",
    "sc_quantity_purchase_shipping": "own supply: bought and on the way",
    "sc_quantity_purchase_plan": "own supply: planned purchases",
    "sc_quantity_local_valid": "own supply: usable in the local warehouse",
    "sc_quantity_local_qc": "own supply: in local inspection",
    "sc_quantity_oversea_valid": "own supply: usable overseas",
    "sc_quantity_local_shipping": "own supply: leaving the local warehouse",
    "sc_quantity_oversea_shipping": "own supply: on the way overseas",
    **{f"sales_avg_{d}": f"mean daily sales of {d} days" for d in (3, 7, 14, 30, 60, 90)},
    **{f"sales_total_{d}": f"units sold in {d} days" for d in (3, 7, 14, 30, 60, 90)},
    "out_stock_date_purchase": "out of stock if only purchases are counted",
    "sug_date_send_oversea": "advised day of sending from overseas",
    "fba_available_sale_days": "days that marketplace stock lasts",
    "out_stock_date_local": "out of stock if local supply is counted",
    "sug_date_purchase": "advised day of purchase",
    "out_stock_flag": "whether it is out of stock",
    "available_sale_days_fba": "days that marketplace stock lasts, under its other name",
    "estimated_sale_avg_quantity": "expected mean daily sales",
    "sug_date_send_local": "advised day of sending from the local warehouse",
    "available_sale_days": "days that all stock lasts",
    "out_stock_date_oversea": "out of stock if overseas supply is counted",
    "out_stock_date": "expected day of being out of stock",
    "estimated_sale_quantity": "expected units sold",
    "quantity_sug_oversea_to_fba": "advised units from overseas to the marketplace",
    "quantity_sug_local_to_oversea": "advised units from local to overseas, by this mode if it says so",
    "sm_id": "id of the mode of transport",
    "name_x": "name of the mode of transport",
    "quantity_sug_purchase": "advised units to buy, by this mode if it says so",
    "quantity_sug_local_to_fba": "advised units from local to the marketplace, by this mode if it says so",
    "restock_status": "state of the restocking",
    "star": "whether it is marked",
    "remark": "remark",
    "name_y": "name of the newest shop row",
    "country": "country of the newest shop row",
}
