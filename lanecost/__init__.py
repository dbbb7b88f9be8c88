"""Freight-cost and delivery-performance analysis over a shipment star schema."""
