"""Two small days of input."""

# customer_id, name, email, phone
CUSTOMERS = {
    "20250903": [
        ("CUST001", "John Doe", "john.doe@example.com", "123-456-7800"),
        ("CUST002", "Jane Smith", "jane.smith@example.com", "123-456-7801"),
        ("CUST003", "Alice Johnson", "alice.johnson@example.com", "123-456-7802"),
        ("CUST004", "Bob Brown", "bob.brown@example.com", "123-456-7803"),
        ("CUST006", "David Evans", "david.evans@example.com", "123-456-7805"),
    ],
    "20250904": [
        ("CUST001", "John Doe", "john.doe_new@example.com", "123-456-7890"),
        ("CUST002", "Jane Smith", "jane.smith@example.com", "123-456-7801"),
        ("CUST003", "Alice Johnson", "alice.johnson_new@example.com", "123-456-7802"),
        ("CUST004", "Bob Brown", "bob.brown@example.com", "123-456-7803"),
        ("CUST013", "Kathy Miller", "kathy.miller@example.com", "123-456-7812"),
    ],
}


def rental(rental_id, customer_id, car, start, end, pickup, dropoff, amount, quantity):
    make, model, year = car
    return {
        "rental_id": rental_id,
        "customer_id": customer_id,
        "car": {"make": make, "model": model, "year": year},
        "rental_period": {"start_date": start, "end_date": end},
        "rental_location": {"pickup_location": pickup, "dropoff_location": dropoff},
        "amount": amount,
        "quantity": quantity,
    }


JFK, LAX, SFO = "New York - JFK Airport", "Los Angeles - LAX Airport", "San Francisco - SFO Airport"
DEN, MIA, SEA = "Denver - DEN Airport", "Miami - MIA Airport", "Seattle - SeaTac Airport"
IAH, DFW = "Houston - Bush Intercontinental Airport", "Dallas - DFW Airport"
# Not spelled as in the seeds, so its key stays NULL.
ORD = "Chicago - O'Hare Airport"

RENTALS = {
    "20250903": [
        rental("RNTL001", "CUST001", ("Tesla", "Model S", 2022), "2025-09-02", "2025-09-08", JFK, DEN, 255.21, 1),
        rental("RNTL002", "CUST002", ("Mercedes-Benz", "C-Class", 2019), "2025-09-02", "2025-09-09", SFO, LAX, 435.9, 5),
        rental("RNTL003", "CUST003", ("Volkswagen", "Passat", 2021), "2025-09-02", "2025-09-07", DEN, MIA, 283.07, 4),
    ],
    "20250904": [
        rental("RNTL051", "CUST004", ("Honda", "Civic", 2019), "2025-09-03", "2025-09-06", SEA, LAX, 461.49, 1),
        rental("RNTL052", "CUST013", ("Volkswagen", "Passat", 2021), "2025-09-03", "2025-09-09", LAX, IAH, 191.76, 4),
        rental("RNTL053", "CUST001", ("Audi", "A4", 2020), "2025-09-03", "2025-09-07", ORD, DFW, 119.13, 4),
    ],
}

# rental_id: duration, total, average, car, pickup, dropoff
GOLDEN = {
    "RNTL001": (6, 255.21, 42.54, 5, 1, 10),
    "RNTL002": (7, 2179.50, 311.36, 8, 5, 2),
    "RNTL003": (5, 1132.28, 226.46, 9, 10, 6),
    "RNTL051": (3, 461.49, 153.83, 2, 7, 2),
    "RNTL052": (6, 767.04, 127.84, 9, 2, 4),
    "RNTL053": (4, 476.52, 119.13, 7, None, 9),
}
